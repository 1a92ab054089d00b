"""Registered queries: one entry per operator, each next to its DuckDB twin."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from moodtide.bindings import sql as S, views as V
from moodtide.functions import dates, text as T
from moodtide.operators import (
    corpus,
    gold,
    lexicon,
    metrics,
    pivots,
    quality,
    retrieval,
    scoring,
    signal,
    silver as sv,
    trends,
)
from moodtide.plans import guidance, weekly_state
from moodtide.schemas import GOLD_POSTS, GOLD_POSTS_REQUIRED, GOLD_WEEKLY, GOLD_WEEKLY_REQUIRED, SILVER
from moodtide.session import materialize, scratch_dir
from moodtide.sources import landing, layers, payloads as cache, split_csv

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, twin: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if twin is not None:
            ORACLE[name] = S.compose(twin)
        return fn

    return register


WEEKS = (dt.date(1997, 1, 6), dt.date(1999, 12, 27))
CUT = f"DATE '{V.CUTOFF}'"
BETWEEN = f"week BETWEEN DATE '{WEEKS[0]}' AND DATE '{WEEKS[1]}'"
WEEKLY_COLUMNS = "week, subreddit, n_posts, sentiment, crisis_rate, crisis_count"
SOURCES = tuple(f"src{i}" for i in range(20))
PERIODS = ("pre", "post", "2018")


WEEKLY_SQL = """SELECT subreddit, week, n_posts, n_active_authors, avg_word_count,
    round(sentiment, 6) AS sentiment, crisis_count, round(crisis_rate, 6) AS crisis_rate FROM weekly"""

_PLACE = "CAST(row_number() OVER (ORDER BY {o}) AS INT) AS position"


def positioned(df: DataFrame) -> DataFrame:
    """Adds the place at which a small sorted result puts each row; ids grow in the order of its partitions."""
    order = Window.orderBy("_at")
    return df.withColumn("_at", F.monotonically_increasing_id()).withColumn("position", F.row_number().over(order)).drop("_at")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Averages differ in the last bits with the order of addition."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, places) for c in doubles})


# --- scans, sources, sinks --------------------------------------------------------


def _write_corpus(spark: SparkSession, sf_dir: str, rows_per_file: int = 0) -> str:
    """The raw posts as corpus files, one folder per file name, of part files with at most so many rows (0: any number)."""
    path = scratch_dir(spark, "corpus")
    raw = V.raw_posts(spark, sf_dir).select(
        (F.col("doc_id") % 10).alias("feature_a"),
        "subreddit",
        "author",
        F.col("created_date").alias("date"),
        "post",
        F.length("post").alias("feature_b"),
        "source_file",
    )
    writer = raw.hint("rebalance", "source_file").write.partitionBy("source_file").option("maxRecordsPerFile", rows_per_file)
    for key in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(key, False)
    writer.option("header", True).option("escape", '"').csv(path)
    return path


@query(
    "csv_landing",
    # An empty field of a CSV file is a missing value.
    "SELECT post_id, subreddit, nullif(author, '') AS author, created_date, post, period, source_file FROM bronze",
)
def csv_landing(spark, sf_dir):
    return split_csv.land(spark, _write_corpus(spark, sf_dir)).drop("ingested_at")


@query(
    "bronze_scan",
    "SELECT post_id, subreddit, author, created_date, post, period, source_file FROM bronze",
)
def bronze_scan(spark, sf_dir):
    path = scratch_dir(spark, "bronze")
    layers.write_bronze(V.bronze(spark, sf_dir), path)
    return layers.read_bronze(spark, path).drop("ingested_at")


@query(
    "file_lineage",
    """SELECT source_file, lower(split_part(source_file, '_', 1)) AS file_subreddit,
              lower(split_part(source_file, '_', 2)) AS file_period, count(*) AS n_rows
       FROM bronze GROUP BY source_file""",
)
def file_lineage(spark, sf_dir):
    return landing.file_lineage(layers.landed_counts(V.bronze(spark, sf_dir)))


def _catalog(spark, sf_dir):
    return V.bronze(spark, sf_dir).groupBy(F.col("source_file").alias("key")).agg(
        F.sum(F.octet_length("post")).alias("size")
    )


@query(
    "catalog_select",
    f"""SELECT CAST(position - 1 AS INT) AS position, key, size, split_part(key, '_', 1) AS file_subreddit,
               split_part(key, '_', 2) AS file_period
        FROM (SELECT unnest([{S.values(SOURCES)}]) || '_pre_posts.csv' AS key,
                     unnest(range(1, {len(SOURCES)} + 1)) AS position) w
        JOIN (SELECT source_file AS key, CAST(sum(strlen(post)) AS BIGINT) AS size FROM bronze
              GROUP BY source_file) c USING (key)""",
)
def catalog_select(spark, sf_dir):
    wanted = landing.wanted_pairs(spark, SOURCES, ["pre"])
    return landing.select_files(wanted, _catalog(spark, sf_dir))


_EXPECTED = f"""
    SELECT s || '_' || p || '_posts.csv' AS expected, s AS file_subreddit, p AS file_period
    FROM (SELECT unnest([{S.values(SOURCES)}]) AS s), (SELECT unnest([{S.values(PERIODS)}]) AS p)
"""


@query(
    "missing_pairs",
    f"""SELECT file_subreddit, file_period FROM ({_EXPECTED})
        WHERE expected NOT IN (SELECT source_file FROM bronze)""",
)
def missing_pairs(spark, sf_dir):
    wanted = landing.wanted_pairs(spark, SOURCES, PERIODS)
    missing = landing.missing_pairs(wanted, _catalog(spark, sf_dir))
    return missing.select("file_subreddit", "file_period")


@query(
    "offline_expand",
    f"""SELECT expected, file_subreddit, file_period,
               expected IN (SELECT source_file FROM bronze) AS present FROM ({_EXPECTED})""",
)
def offline_expand(spark, sf_dir):
    wanted = landing.wanted_pairs(spark, SOURCES, PERIODS)
    files = landing.list_files(spark, _write_corpus(spark, sf_dir))
    return landing.expected_files(wanted, files).select(
        "expected", "file_subreddit", "file_period", (F.col("n_files") > 0).alias("present")
    )


@query(
    "manifest_verify",
    """SELECT CASE WHEN n % 5 = 3 THEN 'lost_' || key ELSE key END AS key,
              CASE WHEN n % 5 = 3 THEN 'missing' WHEN n % 7 = 0 THEN 'mismatch' ELSE 'verified' END AS status
       FROM (SELECT DISTINCT source_file AS key, CAST(regexp_extract(source_file, '[0-9]+') AS INT) AS n FROM bronze)""",
)
def manifest_verify(spark, sf_dir):
    """Written corpus files against the manifest stored for them, some entries of which are altered."""
    path = _write_corpus(spark, sf_dir, rows_per_file=20_000)
    stored = materialize(_corpus_parts(spark, path), "manifest")
    n = F.regexp_extract("key", "[0-9]+", 0).cast("int")
    first = F.min("part").over(Window.partitionBy("key"))
    altered = stored.withColumn("md5", F.when((n % 7 == 0) & (F.col("part") == first), F.md5("md5")).otherwise(F.col("md5")))
    manifest = altered.withColumn("key", F.when(n % 5 == 3, F.concat(F.lit("lost_"), "key")).otherwise(F.col("key")))
    return landing.verify_parts(_corpus_parts(spark, path), manifest).select("key", "status")


def _corpus_parts(spark, path):
    return landing.part_digests(landing.file_digests(spark, path)).where("part LIKE '%.csv'")


@query("bronze_write", "SELECT source_file, count(*) AS n_rows FROM bronze GROUP BY source_file")
def bronze_write(spark, sf_dir):
    return layers.write_bronze(V.bronze(spark, sf_dir), scratch_dir(spark, "bronze"))


SILVER_COLUMNS = "post_id, subreddit, created_date, author_hash, text, period, source_file"


@query("layer_write", f"SELECT {SILVER_COLUMNS} FROM silver")
def layer_write(spark, sf_dir):
    root = scratch_dir(spark, "silver")
    layers.publish(V.silver(spark, sf_dir), root)
    # A table may be rewritten from itself: the next version reads the current one.
    layers.publish(layers.read_layer(spark, root, SILVER), root)
    return layers.read_layer(spark, root, SILVER).drop("ingested_at")


def _micros(day: str):
    return F.unix_date(day).cast("bigint") * dates.MICROS_PER_DAY


@query(
    "warehouse_load",
    """SELECT * REPLACE (round(sentiment_score, 6) AS sentiment_score, round(crisis_score, 6) AS crisis_score)
       FROM scored_posts""",
)
def warehouse_load(spark, sf_dir):
    raw = V.scored_posts(spark, sf_dir).withColumns(
        {"created_date": _micros("created_date"), "week": _micros("week")}
    )
    days = {c: dates.micros_to_date(c) for c in ("created_date", "week")}
    loaded = layers.load_table(
        raw.withColumns(days), GOLD_POSTS, GOLD_POSTS_REQUIRED, scratch_dir(spark, "warehouse")
    )
    return rounded(loaded)


@query("warehouse_load_weekly", WEEKLY_SQL)
def warehouse_load_weekly(spark, sf_dir):
    """The second table of the load: weekly figures, days as micros on the way."""
    raw = V.weekly(spark, sf_dir).withColumn("week", _micros("week"))
    typed = raw.withColumn("week", dates.micros_to_date("week"))
    return rounded(layers.load_table(typed, GOLD_WEEKLY, GOLD_WEEKLY_REQUIRED, scratch_dir(spark, "warehouse")))


@query(
    "warehouse_counts",
    "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS matches FROM scored_posts",
)
def warehouse_counts(spark, sf_dir):
    return layers.verify_counts(V.scored_posts(spark, sf_dir), warehouse_load(spark, sf_dir))


@query(
    "micros_to_date",
    """SELECT event_id, CAST(ts AS DATE) - 20000 AS day FROM events""",
)
def micros_to_date(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    day = F.col("ts").cast("date")
    of_day = F.hour("ts").cast("bigint") * 3600 + F.minute("ts") * 60 + F.second("ts")
    # 20,000 days earlier, so that dates before 1970 are covered too.
    micros = (F.unix_date(day).cast("bigint") - 20000) * dates.MICROS_PER_DAY + of_day * 1000000
    return events.select("event_id", dates.micros_to_date(micros).alias("day"))


@query(
    "weekly_contract",
    f"SELECT {WEEKLY_COLUMNS}, n_active_authors, avg_word_count, {_PLACE.format(o='subreddit, week')} FROM weekly".replace(
        "sentiment, crisis_rate", "round(sentiment, 6) AS sentiment, round(crisis_rate, 6) AS crisis_rate"
    ),
)
def weekly_contract(spark, sf_dir):
    return positioned(rounded(trends.weekly_view(V.weekly(spark, sf_dir))))


@query(
    "source_fallback",
    """SELECT * FROM (SELECT 'live' AS source, count(*) AS n_rows, CAST(sum(n_posts) AS BIGINT) AS posts FROM weekly)
       UNION ALL (SELECT 'fallback', count(*), CAST(sum(n_posts) AS BIGINT) FROM weekly)""",
)
def source_fallback(spark, sf_dir):
    root = scratch_dir(spark, "gold")
    weekly = V.weekly(spark, sf_dir)
    layers.publish(weekly, f"{root}/{layers.WEEKLY_TABLE}")

    def described(path: str) -> DataFrame:
        label, rows = layers.weekly_source(spark, path, weekly)
        return rows.agg(
            F.lit(label).alias("source"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("n_posts").alias("posts"),
        )

    return described(root).unionByName(described(f"{root}-absent"))


@query(
    "export_csv",
    f"""SELECT subreddit, week, n_posts, n_active_authors, avg_word_count, round(sentiment, 6) AS sentiment,
               crisis_count, round(crisis_rate, 6) AS crisis_rate
        FROM weekly WHERE subreddit IN ('1-URGENT', '5-LOW') AND {BETWEEN}""",
)
def export_csv(spark, sf_dir):
    path = scratch_dir(spark, "export")
    view = trends.select_window(V.weekly(spark, sf_dir), ["1-URGENT", "5-LOW"], *WEEKS)
    layers.export_csv(view, path)
    return rounded(layers.read_export(spark, path, GOLD_WEEKLY))


def _pivot_sql(measure: str) -> str:
    return ", ".join(
        f"{measure.format(c=S.quote(c))} AS {chr(34)}{c}{chr(34)}" for c in V.COMMUNITIES
    )


_SENTIMENT_PIVOT = _pivot_sql("round(avg(sentiment) FILTER (subreddit = {c}), 6)")


@query(
    "trend_artifact",
    f"""SELECT *, {_PLACE.format(o='week')}
        FROM (SELECT week, {_SENTIMENT_PIVOT} FROM weekly GROUP BY week ORDER BY week DESC LIMIT 6)""",
)
def trend_artifact(spark, sf_dir):
    path = scratch_dir(spark, "trend")
    matrix = trends.sentiment_pivot(V.weekly(spark, sf_dir), V.COMMUNITIES)
    layers.export_csv(matrix, path)
    return positioned(rounded(trends.trend_tail(layers.read_export(spark, path, matrix.schema))))


@query(
    "payload_cache_scan",
    """SELECT url, cached, CASE WHEN NOT cached THEN 'not cached' END AS reason FROM cleaned_pages""",
)
def payload_cache_scan(spark, sf_dir):
    path = scratch_dir(spark, "payloads")
    V.payloads(spark, sf_dir).write.json(path)
    joined = corpus.join_cache(V.seeds(spark, sf_dir), cache.read_payloads(spark, path))
    return joined.select("url", "cached", F.when(~F.col("cached"), corpus.NOT_CACHED).alias("reason"))


@query(
    "seed_cache_join",
    f"""SELECT position, substr(sha256(url), 1, 20) AS key,
               CASE WHEN cached THEN markdown END AS markdown FROM cleaned_pages""",
)
def seed_cache_join(spark, sf_dir):
    joined = corpus.join_cache(V.seeds(spark, sf_dir), V.payloads(spark, sf_dir))
    return joined.select("position", "key", F.col("data.markdown").alias("markdown"))


@query(
    "payload_validate",
    """SELECT url, CASE WHEN page_id % 11 = 5 THEN 'unsuccessful payload'
                        WHEN coalesce(markdown, '') = '' THEN 'no markdown' END AS reason
       FROM page_markdown""",
)
def payload_validate(spark, sf_dir):
    pages = V.page_markdown(spark, sf_dir).withColumn("success", F.col("page_id") % 11 != 5)
    return pages.select(
        "url", corpus.payload_reason(F.col("success"), F.col("markdown")).alias("reason")
    )


@query(
    "corpus_write_guard",
    """SELECT count(*) AS documents, true AS first_replaced, false AS empty_replaced FROM docs""",
)
def corpus_write_guard(spark, sf_dir):
    root = scratch_dir(spark, "documents")
    docs = corpus.documents(V.crawled(spark, sf_dir))
    first = layers.replace_if_any(docs, root)
    second = layers.replace_if_any(docs.limit(0), root)
    kept = layers.read_layer(spark, root, docs.schema)
    return kept.agg(
        F.count(F.lit(1)).alias("documents"),
        F.lit(first).alias("first_replaced"),
        F.lit(second).alias("empty_replaced"),
    )


# --- projections, filters, predicates ---------------------------------------------


@query("derive_post_id", "SELECT doc_id, period, post_id FROM bronze")
def derive_post_id(spark, sf_dir):
    ids = T.derive_post_id("subreddit", "author", "created_date", "post")
    return V.raw_posts(spark, sf_dir).select("doc_id", "period", ids.alias("post_id"))


@query("normalize_ws", f"SELECT doc_id, period, {S.normalize('post')} AS text FROM raw_posts")
def normalize_ws(spark, sf_dir):
    return V.raw_posts(spark, sf_dir).select(
        "doc_id", "period", T.normalize_space("post").alias("text")
    )


@query("drop_deleted", "SELECT doc_id, period FROM checked WHERE good_text")
def drop_deleted(spark, sf_dir):
    return sv.drop_bad_text(V.raw_posts(spark, sf_dir)).select("doc_id", "period")


@query(
    "hash_author",
    f"""SELECT doc_id, period, CASE WHEN length(author) > 0 THEN sha256('{V.SALT}:' || author) END AS author_hash
        FROM raw_posts""",
)
def hash_author(spark, sf_dir):
    salt = sv.secret_column(spark, V.SALT)
    return V.raw_posts(spark, sf_dir).select(
        "doc_id", "period", T.hash_author("author", salt).alias("author_hash")
    )


def _register_scrub(kind: str, twin: Callable[[str], str]) -> None:
    @query(f"scrub_{kind}", f"SELECT doc_id, period, {twin('post')} AS text FROM raw_posts")
    def scrub(spark, sf_dir):
        return V.raw_posts(spark, sf_dir).select(
            "doc_id", "period", T.scrub_kind("post", kind).alias("text")
        )


for _kind, _twin in (
    ("email", S.email),
    ("url", S.url),
    ("handle", S.handle),
    ("mention", S.mention),
    ("phone", S.phone),
):
    _register_scrub(_kind, _twin)


@query("scrub_text", f"SELECT doc_id, period, {S.scrub('post')} AS text FROM raw_posts")
def scrub_text(spark, sf_dir):
    posts = V.raw_posts(spark, sf_dir).select("doc_id", "period", F.col("post").alias("text"))
    return T.scrub_columns(posts, "text")


@query("scrub_sql_function", f"SELECT doc_id, period, {S.scrub('post')} AS text FROM raw_posts")
def scrub_sql_function(spark, sf_dir):
    T.register_scrub(spark)
    return V.raw_posts(spark, sf_dir).selectExpr("doc_id", "period", "scrub_pii(post) AS text")


@query(
    "anonymize_frame",
    f"""SELECT doc_id, period, {S.scrub('post')} AS post,
               CASE WHEN length(author) > 0 THEN sha256('{V.SALT}:' || author) END AS author_hash FROM raw_posts""",
)
def anonymize_frame(spark, sf_dir):
    posts = V.raw_posts(spark, sf_dir).select("doc_id", "period", "author", "post")
    return sv.anonymize_frame(posts, V.SALT)


@query(
    "parse_dates",
    """SELECT doc_id, period, CAST(try_strptime(created_date, '%Y/%m/%d') AS DATE) AS created_date FROM raw_posts""",
)
def parse_dates(spark, sf_dir):
    return V.raw_posts(spark, sf_dir).select(
        "doc_id", "period", dates.parse_day("created_date").alias("created_date")
    )


@query(
    "rename_project",
    "SELECT subreddit, author, created_date AS date, post AS text, period FROM bronze",
)
def rename_project(spark, sf_dir):
    renamed = V.bronze(spark, sf_dir).withColumnsRenamed({"created_date": "date", "post": "text"})
    return renamed.select("subreddit", "author", "date", "text", "period")


@query(
    "week_start",
    "SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week FROM orders",
)
def week_start(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", dates.week_start(F.col("o_orderdate").cast("date")).alias("week")
    )


@query(
    "length_features",
    f"""SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST({S.word_count('text')} AS BIGINT) AS n_words
        FROM documents""",
)
def length_features(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        T.word_count("text").cast("bigint").alias("n_words"),
    )


@query(
    "typed_nulls",
    """SELECT post_id, CAST(NULL AS DOUBLE) AS sentiment_score, CAST(NULL AS VARCHAR) AS sentiment_label,
              CAST(NULL AS DOUBLE) AS crisis_score, CAST(NULL AS BOOLEAN) AS crisis_flag FROM bronze""",
)
def typed_nulls(spark, sf_dir):
    return gold.with_score_placeholders(V.bronze(spark, sf_dir).select("post_id"))


@query(
    "window_filter",
    f"""SELECT subreddit, week, n_posts FROM weekly
        WHERE subreddit IN ('2-HIGH', '3-MEDIUM') AND {BETWEEN}""",
)
def window_filter(spark, sf_dir):
    view = trends.select_window(V.weekly(spark, sf_dir), ["2-HIGH", "3-MEDIUM"], *WEEKS)
    return view.select("subreddit", "week", "n_posts")


@query(
    "field_dropna",
    "SELECT post_id, round(sentiment_score, 6) AS sentiment_score FROM scored_posts WHERE sentiment_score IS NOT NULL",
)
def field_dropna(spark, sf_dir):
    posts = V.scored_posts(spark, sf_dir).select("post_id", "sentiment_score")
    return rounded(trends.scored_rows(posts, "sentiment_score"))


@query("span_test", f"SELECT coalesce({CUT} BETWEEN min(week) AND max(week), false) AS spans_cutoff FROM weekly")
def span_test(spark, sf_dir):
    return trends.spans(V.weekly(spark, sf_dir), V.CUTOFF)


@query("url_allowlist", "SELECT position, url, url_reason FROM checked_urls")
def url_allowlist(spark, sf_dir):
    checked = corpus.check_urls(V.seeds(spark, sf_dir), V.allowed_hosts(spark, sf_dir))
    return checked.select("position", "url", "url_reason")


@query("thin_page", f"SELECT doc_id, {S.word_count('text')} < 80 AS thin FROM documents")
def thin_page(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select("doc_id", corpus.thin_page("text").alias("thin"))


def _individual(x: str) -> str:
    """RE2's ASCII ``\\b`` next to letters: marks stand in for Unicode boundaries."""
    marked = S.marked(x)
    bounded = "|".join(
        m[len(r"\b(?:") : -len(r")\b")] for m in T.INDIVIDUAL_MARKERS if m.startswith(r"\b")
    )
    plain = "|".join(m for m in T.INDIVIDUAL_MARKERS if not m.startswith(r"\b"))
    plain = plain.replace(r"\w", f"[{S.WORD}]")
    return (
        f"(regexp_matches({marked}, '(?i){S.MARK}(?:{bounded}){S.MARK}') "
        f"OR regexp_matches({x}, '(?i){plain}'))"
    )


@query(
    "individual_request",
    f"SELECT conv_id, turn, {_individual('question')} AS refused FROM questions",
)
def individual_request(spark, sf_dir):
    return V.questions(spark, sf_dir).select(
        "conv_id", "turn", T.targets_individual("question").alias("refused")
    )


# --- joins ------------------------------------------------------------------------

_DONE = "SELECT post_id FROM silver WHERE author_hash IS NULL OR author_hash < '8'"


def _done(posts: DataFrame) -> DataFrame:
    """Posts a previous run has scored: about half of the authors."""
    return posts.where("author_hash IS NULL OR author_hash < '8'")


def _score(posts: DataFrame) -> DataFrame:
    return scoring.score_with_lexicon(posts, V.POSITIVE, V.NEGATIVE)


def _earlier_scores(posts: DataFrame) -> DataFrame:
    return _score(_done(posts))


@query(
    "apply_scores",
    f"""SELECT g.post_id, subreddit, week, n_words, s.sentiment_score, s.sentiment_label
       FROM gold_posts g LEFT JOIN (SELECT * FROM lexicon_scores WHERE post_id IN ({_DONE})) s USING (post_id)""",
)
def apply_scores(spark, sf_dir):
    posts = V.stored_silver(spark, sf_dir)
    merged = gold.apply_scores(
        gold.gold_posts(posts), _earlier_scores(posts), gold.SENTIMENT_COLUMNS
    )
    return merged.select(
        "post_id", "subreddit", "week", "n_words", "sentiment_score", "sentiment_label"
    )


@query(
    "bucketed_merge",
    f"""SELECT g.post_id, subreddit, week, n_words, s.sentiment_score, s.sentiment_label
       FROM gold_posts g LEFT JOIN (SELECT * FROM lexicon_scores WHERE post_id IN ({_DONE})) s USING (post_id)""",
)
def bucketed_merge(spark, sf_dir):
    """The score merge on two tables bucketed by post: neither is shuffled."""
    silver = V.stored_silver(spark, sf_dir)
    stored = {}
    for name, df in {"posts": gold.gold_posts(silver), "scores": _earlier_scores(silver)}.items():
        path = scratch_dir(spark, f"bucketed-{name}")
        table = path.rsplit("/", 1)[1].replace("-", "_")
        layers.save_bucketed(df, table, buckets=16, path=path)
        stored[name] = spark.table(table)
    merged = gold.apply_scores(stored["posts"], stored["scores"], gold.SENTIMENT_COLUMNS)
    return merged.select("post_id", "subreddit", "week", "n_words", "sentiment_score", "sentiment_label")


@query(
    "features_join",
    f"""SELECT g.post_id, coalesce(s.sentiment_score, 0.0) AS sentiment_score
       FROM gold_posts g LEFT JOIN (SELECT * FROM lexicon_scores WHERE post_id IN ({_DONE})) s USING (post_id)""",
)
def features_join(spark, sf_dir):
    posts = V.stored_silver(spark, sf_dir)
    return signal.join_sentiment(posts.select("post_id"), _earlier_scores(posts))


@query("todo_antijoin", f"SELECT post_id, text FROM silver WHERE post_id NOT IN ({_DONE})")
def todo_antijoin(spark, sf_dir):
    posts = V.stored_silver(spark, sf_dir)
    return scoring.unscored(posts.select("post_id", "text"), _done(posts))


_LEAK = f"CASE WHEN author = 'user_5' THEN author WHEN length(author) > 0 THEN sha256('{V.SALT}:' || author) END"


def _leaky(spark, sf_dir) -> DataFrame:
    """A broken layer: one author was never hashed."""
    secret = sv.secret_column(spark, V.SALT)
    broken = F.when(F.col("author") == "user_5", F.col("author")).otherwise(
        T.hash_author("author", secret)
    )
    return V.bronze(spark, sf_dir).select("post_id", broken.alias("author_hash"))


@query("leak_semijoin", f"SELECT DISTINCT author_hash FROM (SELECT {_LEAK} AS author_hash FROM bronze) WHERE author_hash IN (SELECT author FROM bronze)")
def leak_semijoin(spark, sf_dir):
    return sv.leaked_hashes(_leaky(spark, sf_dir), sv.distinct_authors(V.bronze(spark, sf_dir)))




def _sides(places: int) -> str:
    return ", ".join(
        f"{S.round_even(f'avg({m}) FILTER (week {op} {CUT})', places)} AS {m}_{side}"
        for m in ("sentiment", "crisis_rate")
        for side, op in (("pre", "<"), ("post", ">="))
    )


def _delta(m: str) -> str:
    difference = f"avg({m}) FILTER (week >= {CUT}) - avg({m}) FILTER (week < {CUT})"
    return f"{S.round_even(difference, 4)} AS {m}_delta"


_POSTS = ", ".join(
    f"CAST(sum(n_posts) FILTER (week {op} {CUT}) AS BIGINT) AS posts_{side}"
    for side, op in (("pre", "<"), ("post", ">="))
)
_BOTH = f"HAVING count(*) FILTER (week < {CUT}) > 0 AND count(*) FILTER (week >= {CUT}) > 0"


@query(
    "pre_post_join",
    f"SELECT subreddit, {_sides(6)}, {_POSTS} FROM weekly GROUP BY subreddit {_BOTH}",
)
def pre_post_join(spark, sf_dir):
    return rounded(trends.pre_post_join(V.weekly(spark, sf_dir), V.CUTOFF))


# --- aggregations -----------------------------------------------------------------

@query("weekly_rollup", WEEKLY_SQL)
def weekly_rollup(spark, sf_dir):
    return rounded(V.weekly(spark, sf_dir))


@query(
    "weekly_from_documents",
    f"""SELECT subreddit, week, count(*) AS n_posts, count(DISTINCT author_hash) AS n_active_authors,
              {S.round_even('avg(n_words)', 2)} AS avg_word_count, CAST(NULL AS DOUBLE) AS sentiment,
              CAST(NULL AS BIGINT) AS crisis_count, CAST(NULL AS DOUBLE) AS crisis_rate
       FROM gold_posts GROUP BY subreddit, week""",
)
def weekly_from_documents(spark, sf_dir):
    return gold.weekly_rollup(V.gold_posts(spark, sf_dir))


@query(
    "kpis",
    """SELECT count(DISTINCT subreddit) AS communities, CAST(coalesce(sum(n_posts), 0) AS BIGINT) AS total_posts,
              round(avg(sentiment), 6) AS avg_sentiment,
              round(coalesce(sum(crisis_count) / CAST(sum(n_posts) AS DOUBLE), 0), 6) AS crisis_share FROM weekly""",
)
def kpis(spark, sf_dir):
    return rounded(trends.kpis(V.weekly(spark, sf_dir)))


@query("community_overview", "SELECT * FROM overview")
def community_overview(spark, sf_dir):
    return trends.community_overview(V.weekly(spark, sf_dir))


@query(
    "event_impact_split",
    f"""SELECT subreddit, {_sides(4)}, {_POSTS},
               {_delta('sentiment')}, {_delta('crisis_rate')}
        FROM weekly GROUP BY subreddit {_BOTH}""",
)
def event_impact_split(spark, sf_dir):
    return trends.event_impact(V.weekly(spark, sf_dir), V.CUTOFF)


@query("sentiment_pivot", f"SELECT week, {_SENTIMENT_PIVOT} FROM weekly GROUP BY week")
def sentiment_pivot(spark, sf_dir):
    return rounded(trends.sentiment_pivot(V.weekly(spark, sf_dir), V.COMMUNITIES))


_VOLUME_PIVOT = _pivot_sql("CAST(sum(crisis_count) FILTER (subreddit = {c}) AS BIGINT)")


@query("crisis_volume_pivot", f"SELECT week, {_VOLUME_PIVOT} FROM weekly GROUP BY week")
def crisis_volume_pivot(spark, sf_dir):
    return trends.crisis_volume_pivot(V.weekly(spark, sf_dir), V.COMMUNITIES)


@query(
    "label_shares",
    """SELECT sentiment_label, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share,
              CAST(sum(count(*)) OVER () AS BIGINT) AS n_scored,
              round(sum(sum(sentiment_score)) OVER () / sum(count(*)) OVER (), 6) AS mean_sentiment
       FROM scored_posts WHERE sentiment_score IS NOT NULL GROUP BY sentiment_label""",
)
def label_shares(spark, sf_dir):
    return rounded(scoring.label_shares(V.scored_posts(spark, sf_dir)))


@query(
    "drop_audit",
    """SELECT count(*) FILTER (NOT good_text) AS empty_or_deleted_text,
              count(*) FILTER (good_text AND good_day IS NULL) AS unparseable_date,
              count(*) FILTER (good_text AND good_day IS NOT NULL)
                - count(DISTINCT post_id) FILTER (good_text AND good_day IS NOT NULL) AS duplicate_post_id
       FROM checked""",
)
def drop_audit(spark, sf_dir):
    return sv.drop_audit(V.bronze(spark, sf_dir))


@query(
    "run_report",
    """SELECT (SELECT count(*) FROM bronze) AS bronze_rows, (SELECT count(DISTINCT author) FROM bronze) AS raw_authors,
              count(*) AS silver_rows, min(created_date) AS first_day, max(created_date) AS last_day,
              count(DISTINCT date_trunc('week', created_date)) AS weeks, count(DISTINCT subreddit) AS communities
       FROM silver""",
)
def run_report(spark, sf_dir):
    return sv.run_report(V.bronze(spark, sf_dir), V.silver(spark, sf_dir))


@query(
    "corpus_report",
    f"""SELECT (SELECT count(*) FROM crawled) AS seeds, count(*) AS documents,
               (SELECT count(*) FROM chunks SEMI JOIN docs USING (content_hash)) AS chunks,
               CAST(sum({S.word_count('text')}) AS BIGINT) AS words,
               count(DISTINCT source) AS sources, count(DISTINCT topic) AS topics,
               (SELECT count(reason) FROM crawled) AS failures
        FROM docs""",
)
def corpus_report(spark, sf_dir):
    """The whole build: crawl, de-duplicate, chunk, publish, report."""
    report, _ = guidance.build(
        V.seeds(spark, sf_dir),
        V.payloads(spark, sf_dir),
        scratch_dir(spark, "corpus"),
        V.allowed_hosts(spark, sf_dir),
        retrieved_at=F.lit(V.RETRIEVED_AT),
    )
    return report


@query(
    "corpus_names",
    """SELECT 'source' AS kind, source AS name, count(*) AS documents FROM docs GROUP BY source
       UNION ALL SELECT 'topic', topic, count(*) FROM docs GROUP BY topic""",
)
def corpus_names(spark, sf_dir):
    return corpus.corpus_names(corpus.documents(V.crawled(spark, sf_dir)))


@query(
    "active_authors_avg",
    """SELECT round(avg(n_active_authors), 6) AS avg_active_authors, count(DISTINCT week) AS weeks,
              min(week) AS first_week, max(week) AS last_week, CAST(sum(n_posts) AS BIGINT) AS posts,
              count(DISTINCT subreddit) AS communities FROM weekly""",
)
def active_authors_avg(spark, sf_dir):
    return rounded(trends.activity(V.weekly(spark, sf_dir)))


def _signal_scores(spark, sf_dir) -> DataFrame:
    rows = V.training_rows(spark, sf_dir)
    return signal.score_linear(rows, V.COEFFICIENTS, V.INTERCEPT, V.THRESHOLD, keep=("label",))


_RATIO = "coalesce({a} / CAST(nullif({b}, 0) AS DOUBLE), 0)"
_FLAGGED = f"count(*) FILTER (crisis_score >= {V.THRESHOLD})"
_TRUE = f"count(*) FILTER (crisis_score >= {V.THRESHOLD} AND label = 1)"
_POSITIVE = "count(*) FILTER (label = 1)"


@query(
    "classifier_metrics",
    f"""SELECT round({_RATIO.format(a=_TRUE, b=_FLAGGED)}, 6) AS precision,
               round({_RATIO.format(a=_TRUE, b=_POSITIVE)}, 6) AS recall,
               round({_RATIO.format(a='2 * ' + _TRUE, b=f'({_FLAGGED} + {_POSITIVE})')}, 6) AS f1,
               round({_POSITIVE} / CAST(count(*) AS DOUBLE), 6) AS weak_label_rate,
               round({_FLAGGED} / CAST(count(*) AS DOUBLE), 6) AS flag_rate,
               (SELECT round((sum(r) FILTER (label = 1) - {_POSITIVE} * ({_POSITIVE} + 1) / 2.0)
                             / ({_POSITIVE} * CAST(count(*) FILTER (label = 0) AS DOUBLE)), 6)
                FROM (SELECT label, rank() OVER (ORDER BY crisis_score)
                             + (count(*) OVER (PARTITION BY crisis_score) - 1) / 2.0 AS r
                      FROM signal_scores)) AS auc
        FROM signal_scores""",
)
def classifier_metrics(spark, sf_dir):
    scored = _signal_scores(spark, sf_dir)
    return rounded(signal.classifier_metrics(scored, "crisis_score", "label", V.THRESHOLD))


@query(
    "calibrate_threshold",
    """SELECT threshold, round(flag_rate, 6) AS flag_rate, round(label_rate, 6) AS label_rate
       FROM (SELECT score AS threshold,
                    sum(pos + neg) OVER (ORDER BY score DESC) / CAST(sum(pos + neg) OVER () AS DOUBLE) AS flag_rate,
                    sum(pos) OVER () / CAST(sum(pos + neg) OVER () AS DOUBLE) AS label_rate FROM score_bins)
       ORDER BY abs(flag_rate - label_rate), threshold DESC LIMIT 1""",
)
def calibrate_threshold(spark, sf_dir):
    found = signal.calibrate_threshold(_signal_scores(spark, sf_dir), "crisis_score", "label")
    return rounded(found)


_REVIEWED = f"""
    SELECT CASE WHEN neg >= pos AND neg >= 1 THEN 'negative' WHEN pos > 1 THEN 'positive' ELSE 'neutral' END AS sentiment_label,
           (pos - neg) / CAST(pos + neg + 1 AS DOUBLE) AS score,
           CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'mixed' END AS review
    FROM (SELECT doc_id, {S.count_hits('text', V.POSITIVE)} AS pos, {S.count_hits('text', V.NEGATIVE)} AS neg
          FROM documents) JOIN labels USING (doc_id)
"""


@query(
    "label_agreement",
    f"""SELECT sentiment_label, review, count(*) AS n, round(avg({S.round_even('score', 4)}), 6) AS mean_score,
               round(sum(CASE WHEN sentiment_label = review THEN count(*) ELSE 0 END) OVER ()
                     / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS exact_agreement,
               round(sum(CASE WHEN replace(sentiment_label, 'neutral', 'mixed') = review THEN count(*) ELSE 0 END) OVER ()
                     / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS compatible_agreement
        FROM ({_REVIEWED}) GROUP BY sentiment_label, review""",
)
def label_agreement(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").withColumn("post_id", F.col("doc_id"))
    scores = scoring.score_with_lexicon(docs, V.POSITIVE, V.NEGATIVE)
    review = (
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("mixed")
    )
    reviewed = V.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("post_id"), review.alias("review")
    )
    joined = scores.join(reviewed, "post_id")
    return rounded(scoring.label_agreement(joined, "sentiment_label", "review", "sentiment_score"))


@query(
    "reconcile",
    """SELECT subreddit, rows_left, rows_right, first_left, first_right, last_left, last_right,
              rows_left = rows_right AND first_left = first_right AND last_left = last_right AS matches
       FROM (SELECT subreddit, count(*) AS rows_left, min(week) AS first_left, max(week) AS last_left,
                    count(sentiment_score) AS rows_right,
                    min(week) FILTER (sentiment_score IS NOT NULL) AS first_right,
                    max(week) FILTER (sentiment_score IS NOT NULL) AS last_right
             FROM scored_posts GROUP BY subreddit)""",
)
def reconcile(spark, sf_dir):
    posts = V.scored_posts(spark, sf_dir)
    partial = trends.scored_rows(posts, "sentiment_score")
    return quality.reconcile(posts, partial, "subreddit", "week")


# --- windows ----------------------------------------------------------------------


@query("dedupe_first", "SELECT post_id, period, source_file, good_day AS created_date FROM deduped")
def dedupe_first(spark, sf_dir):
    return V.silver(spark, sf_dir).select("post_id", "period", "source_file", "created_date")


@query(
    "smooth",
    """SELECT subreddit, week, round(avg(sentiment) OVER w, 6) AS sentiment, round(avg(crisis_rate) OVER w, 6) AS crisis_rate
       FROM weekly WINDOW w AS (PARTITION BY subreddit ORDER BY week ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def smooth(spark, sf_dir):
    smoothed = trends.smooth(V.weekly(spark, sf_dir), 3)
    return rounded(smoothed.select("subreddit", "week", "sentiment", "crisis_rate"))


@query("content_dedupe", "SELECT content_hash, url, title, source, topic FROM all_docs")
def content_dedupe(spark, sf_dir):
    return V.all_documents(spark, sf_dir).select(
        "content_hash", "url", "title", "source", "topic"
    )


@query("chunk_index", "SELECT format('{}-{:03d}', content_hash, chunk_index) AS chunk_id, CAST(chunk_index AS INT) AS chunk_index FROM chunks")
def chunk_index(spark, sf_dir):
    return corpus.chunk_documents(V.all_documents(spark, sf_dir)).select("chunk_id", "chunk_index")


# --- order and limits -------------------------------------------------------------


@query("ordered_weekly", f"SELECT *, {_PLACE.format(o='subreddit, week')} FROM ({WEEKLY_SQL})")
def ordered_weekly(spark, sf_dir):
    return positioned(gold.ordered_weekly(rounded(V.weekly(spark, sf_dir))))


@query(
    "extreme_communities",
    """SELECT n.subreddit AS most_negative, n.avg_sentiment, h.subreddit AS highest_share, h.crisis_share
       FROM (SELECT * FROM overview ORDER BY avg_sentiment, subreddit LIMIT 1) n,
            (SELECT * FROM overview ORDER BY crisis_share DESC, subreddit LIMIT 1) h""",
)
def extreme_communities(spark, sf_dir):
    return trends.extremes(V.weekly(spark, sf_dir))


@query("overview_rank", f"SELECT *, {_PLACE.format(o='posts DESC, subreddit')} FROM overview")
def overview_rank(spark, sf_dir):
    return positioned(trends.ranked_overview(V.weekly(spark, sf_dir)))


@query("head_limit", "SELECT post_id, text FROM silver ORDER BY post_id LIMIT 100")
def head_limit(spark, sf_dir):
    return scoring.first_posts(V.silver(spark, sf_dir).select("post_id", "text"), 100)


@query(
    "coef_rank",
    "SELECT feature, abs(coefficient) AS size, " + _PLACE.format(o="abs(coefficient) DESC, feature") + " FROM fitted_weights",
)
def coef_rank(spark, sf_dir):
    """Features in the order in which the fitted model's coefficients put them."""
    _, _, ranked = signal.fit_and_score(V.training_rows(spark, sf_dir), V.THRESHOLD)
    return positioned(ranked.select("feature", F.abs("coefficient").alias("size")))


# --- set operations ---------------------------------------------------------------


@query(
    "union_files",
    "SELECT source_file, period, count(*) AS n_rows, count(DISTINCT post_id) AS ids FROM bronze GROUP BY source_file, period",
)
def union_files(spark, sf_dir):
    """Two landing folders read as one table."""
    rows = V.bronze(spark, sf_dir)
    early, late = scratch_dir(spark, "bronze"), scratch_dir(spark, "bronze")
    layers.write_bronze(rows.where("period <> '2019'"), early)
    layers.write_bronze(rows.where("period = '2019'"), late)
    both = layers.read_bronze(spark, early).unionByName(layers.read_bronze(spark, late))
    return both.groupBy("source_file", "period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("post_id").alias("ids")
    )


@query("append_scores", "SELECT * FROM lexicon_scores")
def append_scores(spark, sf_dir):
    posts = V.silver(spark, sf_dir)
    fresh = _score(posts.where("author_hash >= '8'"))
    return scoring.append_scores(_earlier_scores(posts), fresh.select(*reversed(fresh.columns)))


@query(
    "hash_intersection",
    f"""SELECT 'silver' AS layer, author_hash FROM
            (SELECT author_hash FROM silver WHERE author_hash IS NOT NULL INTERSECT SELECT author FROM bronze)
        UNION ALL SELECT 'leaky', author_hash FROM
            (SELECT {_LEAK} AS author_hash FROM bronze WHERE author <> '' INTERSECT SELECT author FROM bronze)""",
)
def hash_intersection(spark, sf_dir):
    """Of a clean layer, where it is empty, and of one in which an author was not hashed."""
    authors = sv.distinct_authors(V.bronze(spark, sf_dir))
    of = {"silver": V.silver(spark, sf_dir), "leaky": _leaky(spark, sf_dir)}
    found = [sv.leaked_hashes(layer, authors).select(F.lit(name).alias("layer"), "author_hash") for name, layer in of.items()]
    return found[0].union(found[1])


@query("distinct_authors", "SELECT DISTINCT author FROM bronze WHERE author IS NOT NULL")
def distinct_authors(spark, sf_dir):
    return sv.distinct_authors(V.bronze(spark, sf_dir))


# --- scoring and signal -----------------------------------------------------------


@query(
    "lexicon_distinct_hits",
    f"SELECT doc_id, {S.distinct_hits('text', V.SEVERE)} AS hits FROM documents",
)
def lexicon_distinct_hits(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select(
        "doc_id", T.distinct_hits("text", V.SEVERE).alias("hits")
    )


@query(
    "lexicon_count_hits",
    f"SELECT doc_id, CAST({S.count_hits('text', V.SEVERE + V.POSITIVE)} AS INT) AS hits FROM documents",
)
def lexicon_count_hits(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select(
        "doc_id", T.count_hits("text", V.SEVERE + V.POSITIVE).alias("hits")
    )


_LISTS = {"acute": T.ACUTE_PHRASES, "severe": T.SEVERE_TERMS, "first": T.FIRST_PERSON, "negation": T.NEGATION, "rude": V.NEGATIVE, "kind": V.POSITIVE}


@query(
    "lexicon_scan",
    "SELECT doc_id, "
    + ", ".join(f"CAST({S.distinct_hits('text', t)} AS BIGINT) AS {n}_distinct, CAST({S.count_hits('text', t)} AS BIGINT) AS {n}_count" for n, t in _LISTS.items())
    + " FROM documents",
)
def lexicon_scan(spark, sf_dir):
    """All lists in one pass over the texts."""
    return lexicon.lexicon_hits(V.table(spark, sf_dir, "documents").select("doc_id", "text"), _LISTS).drop("text")


@query("weak_labels", "SELECT * FROM weak")
def weak_labels(spark, sf_dir):
    return V.labels(spark, sf_dir)


@query(
    "weak_labels_default",
    f"""SELECT doc_id AS post_id,
               CAST(({S.distinct_hits('text', T.ACUTE_PHRASES)}) >= 1
                    OR ({S.distinct_hits('text', T.SEVERE_TERMS)}) >= 2 AS BIGINT) AS label FROM documents""",
)
def weak_labels_default(spark, sf_dir):
    docs = V.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"), "text")
    return signal.weak_labels(docs)


@query(
    "token_density",
    """SELECT post_id, round(severe_density, 6) AS severe_density, round(first_person_density, 6) AS first_person_density,
              round(negation_density, 6) AS negation_density, round(log_n_words, 6) AS log_n_words FROM densities""",
)
def token_density(spark, sf_dir):
    return rounded(signal.token_densities(V.silver(spark, sf_dir), V.SEVERE))


_FEATURE_SQL = ", ".join(f"round({f}, 6) AS {f}" for f in signal.FEATURES)


@query("build_features", f"SELECT post_id, {_FEATURE_SQL} FROM features")
def build_features(spark, sf_dir):
    """Scores join the features once, and are derived in the same stage as those."""
    silver = V.stored_silver(spark, sf_dir)
    return rounded(signal.build_features(silver, gold.unique_scores(_score(silver), "sentiment_score"), V.SEVERE))


@query(
    "stratified_split",
    """SELECT post_id, label,
              row_number() OVER (PARTITION BY label ORDER BY md5(post_id || ':7'), post_id) <= quota AS is_train
       FROM weak JOIN split_quotas USING (label)""",
)
def stratified_split(spark, sf_dir):
    # The rows are passed over three times; written once, the texts are read once.
    return signal.stratified_split(materialize(V.labels(spark, sf_dir), "labels"))


@query(
    "standardize",
    "SELECT post_id, "
    + ", ".join(
        f"round(({f} - avg({f}) OVER ()) / coalesce(nullif(stddev_pop({f}) OVER (), 0), 1), 6) AS {f}"
        for f in signal.FEATURES
    )
    + " FROM features",
)
def standardize(spark, sf_dir):
    return rounded(signal.standardize(materialize(V.features(spark, sf_dir), "features")))


@query("train_logistic", "SELECT post_id, crisis_score, p >= 0.5 AS crisis_flag FROM fitted")
def train_logistic(spark, sf_dir):
    """Scores of a model fitted on the spot; the twin takes its own Newton steps."""
    scores, _, _ = signal.fit_and_score(V.training_rows(spark, sf_dir), V.THRESHOLD)
    return scores


@query(
    "holdout_report",
    """SELECT round(tp / flagged, 6) AS precision, round(tp / pos, 6) AS recall, round(2 * tp / (flagged + pos), 6) AS f1,
              round(pos / n, 6) AS weak_label_rate, round(flagged / n, 6) AS flag_rate, round(wins / (pos * neg), 6) AS auc
       FROM (SELECT count(*) FILTER (p >= 0.5) AS flagged, count(*) FILTER (p >= 0.5 AND label = 1) AS tp,
                    count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg, count(*) AS n,
                    sum(CASE WHEN label = 1 THEN below + alike / 2 END) AS wins
             FROM (SELECT p, label, coalesce(sum(CAST(label = 0 AS INT)) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING EXCLUDE GROUP), 0) AS below,
                          sum(CAST(label = 0 AS INT)) OVER (PARTITION BY p) AS alike
                   FROM fitted WHERE NOT is_train))""",
)
def holdout_report(spark, sf_dir):
    """How the fitted model does on the fifth of posts that it has not seen."""
    _, report, _ = signal.fit_and_score(V.training_rows(spark, sf_dir), V.THRESHOLD)
    return rounded(report)


@query(
    "importances",
    "SELECT feature, coefficient, " + _PLACE.format(o="abs(coefficient) DESC, feature") + " FROM fitted_weights",
)
def importances(spark, sf_dir):
    """Coefficients of the fitted model, in the order of their size."""
    _, _, ranked = signal.fit_and_score(V.training_rows(spark, sf_dir), V.THRESHOLD)
    return positioned(ranked)


@query("score_flag", "SELECT post_id, crisis_score, crisis_flag FROM signal_scores")
def score_flag(spark, sf_dir):
    return signal.score_linear(
        V.features(spark, sf_dir), V.COEFFICIENTS, V.INTERCEPT, V.THRESHOLD
    )


@query("score_posts", "SELECT * FROM lexicon_scores")
def score_posts(spark, sf_dir):
    return V.lexicon_scores(spark, sf_dir)


class LexiconScorer:
    """The lexicon scorer behind the pluggable batch interface."""

    def score_texts(self, texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        low = pc.utf8_lower(pa.array(texts, pa.large_string()))

        def hits(terms):
            return sum(pc.count_substring(low, t).to_numpy() for t in terms)

        pos, neg = hits(V.POSITIVE), hits(V.NEGATIVE)
        return np.stack([neg, np.ones(len(low)), pos], 1) / (pos + neg + 1)[:, None]


@query("score_posts_batched", "SELECT * FROM lexicon_scores")
def score_posts_batched(spark, sf_dir):
    return scoring.score_posts(V.silver(spark, sf_dir), LexiconScorer, by_length=False)


_EVENT_P = """SELECT event_id, 1 / (1 + value / 100) AS a, (value / 100) / (1 + value / 100) AS b, event_id % 7 AS m FROM events"""


@query(
    "prob_to_label",
    f"""SELECT event_id, {S.round_even('p3 - p1', 4)} AS sentiment_score,
               CASE WHEN p1 >= p2 AND p1 >= p3 THEN 'negative' WHEN p2 >= p3 THEN 'neutral' ELSE 'positive' END AS sentiment_label
        FROM (SELECT event_id, a * m / 10 AS p1, b AS p2, a * (10 - m) / 10 AS p3 FROM ({_EVENT_P}))""",
)
def prob_to_label(spark, sf_dir):
    x = F.col("value") / 100
    a, b, m = 1 / (1 + x), x / (1 + x), F.col("event_id") % 7
    probabilities = F.array(a * m / 10, b, a * (10 - m) / 10)
    events = V.table(spark, sf_dir, "events").select("event_id", probabilities.alias("probabilities"))
    return scoring.score_probabilities(events)


@query("length_batching", "SELECT post_id, CAST(length(text) AS INT) AS n_chars, true AS in_order FROM silver")
def length_batching(spark, sf_dir):
    """Each post with its length, and whether the one before it in its task is no longer."""
    ordered = scoring.length_ordered(V.silver(spark, sf_dir).select("post_id", "text"))
    placed = ordered.select("post_id", F.length("text").alias("n_chars"), F.monotonically_increasing_id().alias("at"))
    before = F.lag("n_chars").over(Window.partitionBy(F.shiftright("at", 33)).orderBy("at"))  # the upper bits number the task
    return placed.select("post_id", "n_chars", F.coalesce(before <= F.col("n_chars"), F.lit(True)).alias("in_order"))


@query("incremental_scoring", "SELECT * FROM lexicon_scores")
def incremental_scoring(spark, sf_dir):
    posts = V.stored_silver(spark, sf_dir)
    table = scratch_dir(spark, "scores")
    _earlier_scores(posts).write.parquet(table)
    return scoring.resume_scoring(posts, spark.read.parquet(table), _score)


@query(
    "refresh_gold",
    f"""SELECT subreddit, week, count(*) AS n_posts, count(DISTINCT author_hash) AS n_active_authors,
              {S.round_even('avg(n_words)', 2)} AS avg_word_count, round(avg(sentiment_score), 6) AS sentiment,
              CAST(sum(CAST(crisis_flag AS INT)) AS BIGINT) AS crisis_count,
              round(sum(CAST(crisis_flag AS INT)) / CAST(count(*) AS DOUBLE), 6) AS crisis_rate
       FROM gold_posts LEFT JOIN lexicon_scores USING (post_id) LEFT JOIN signal_scores USING (post_id)
       GROUP BY subreddit, week""",
)
def refresh_gold(spark, sf_dir):
    silver = V.stored_silver(spark, sf_dir)
    rows = V.training_rows_of(silver)
    flags = signal.score_linear(rows, V.COEFFICIENTS, V.INTERCEPT, V.THRESHOLD)
    scored, _ = gold.refresh(gold.gold_posts(silver), _score(silver), gold.SENTIMENT_COLUMNS)
    _, weekly = gold.refresh(scored, flags, gold.CRISIS_COLUMNS)
    return rounded(weekly)


@query("incremental_weekly", WEEKLY_SQL)
def incremental_weekly(spark, sf_dir):
    """All orders in three batches, the last of late ones, scores for some weeks afterwards: as if rolled up at once."""
    posts, root = V.scored_posts(spark, sf_dir), scratch_dir(spark, "weekly-state")
    key = F.col("post_id").cast("long")
    late, cut = key % 10 == 3, F.col("week") >= dt.date(1998, 1, 5)
    unscored = posts.withColumn("sentiment_score", F.when(F.col("week") < WEEKS[0], F.lit(None).cast("double")).otherwise(F.col("sentiment_score")))
    for name, chosen in (("first", ~cut & ~late), ("second", cut & ~late), ("late", late)):
        weekly_state.add_batch(unscored.where(chosen), root, name, span="year")
    scores = posts.where(F.col("week") < WEEKS[0]).select("post_id", "sentiment_score", "sentiment_label")
    weekly_state.rescore(spark, root, scores, gold.SENTIMENT_COLUMNS)
    return rounded(weekly_state.read_weekly(spark, root))


# --- guidance corpus --------------------------------------------------------------


@query("clean_markdown", f"SELECT page_id, {S.clean_markdown('markdown')} AS text FROM page_markdown")
def clean_markdown(spark, sf_dir):
    return V.page_markdown(spark, sf_dir).select(
        "page_id", T.clean_markdown("markdown").alias("text")
    )


@query(
    "to_document",
    "SELECT position, title, url, source, topic, text, content_hash FROM crawled WHERE reason IS NULL",
)
def to_document(spark, sf_dir):
    return V.crawled(spark, sf_dir).where("reason IS NULL").select(
        "position", "title", "url", "source", "topic", "text", "content_hash"
    )


@query("crawl_sources", "SELECT position, seed_url, reason FROM crawled")
def crawl_sources(spark, sf_dir):
    return V.crawled(spark, sf_dir).select("position", "seed_url", "reason")


@query(
    "chunk_documents",
    """SELECT format('{}-{:03d}', c.content_hash, c.chunk_index) AS chunk_id, c.text, d.url, d.title, d.source, d.topic,
              d.retrieved_at, CAST(c.chunk_index AS INT) AS chunk_index
       FROM chunks c JOIN all_docs d USING (content_hash)""",
)
def chunk_documents(spark, sf_dir):
    return corpus.chunk_documents(V.all_documents(spark, sf_dir))


# --- retrieval, metric templates, questions ---------------------------------------


def _topic_queries(spark, sf_dir) -> DataFrame:
    """One query per topic, written once: the search measures them, then sends them along."""
    centroids = retrieval.topic_centroids(V.passages(spark, sf_dir))
    queries = centroids.select(F.col("topic").cast("bigint").alias("query_id"), "topic", "embedding")
    return materialize(queries, "queries")


_RANK = "row_number() OVER (PARTITION BY query_id ORDER BY {s} DESC, doc_id)"


@query(
    "topk_retrieval",
    f"""SELECT CAST(query_id AS BIGINT) AS query_id, doc_id, round(cosine, 6) AS score,
               CAST({_RANK.format(s='cosine')} AS INT) AS rank FROM similarities
        QUALIFY {_RANK.format(s='cosine')} <= 5""",
)
def topk_retrieval(spark, sf_dir):
    """By the stored index of pivots, which skips most documents; ``topk_by_topic`` compares all of a topic."""
    return rounded(pivots.search(_topic_queries(spark, sf_dir), pivots.build(V.passages(spark, sf_dir)), 5))


@query(
    "topk_by_topic",
    f"""SELECT CAST(query_id AS BIGINT) AS query_id, doc_id, round(cosine, 6) AS score,
               CAST({_RANK.format(s='cosine')} AS INT) AS rank FROM similarities WHERE topic = query_id
        QUALIFY {_RANK.format(s='cosine')} <= 5""",
)
def topk_by_topic(spark, sf_dir):
    return rounded(
        retrieval.top_k(
            _topic_queries(spark, sf_dir), V.passages(spark, sf_dir), 5, by_topic=True
        )
    )


@query(
    "retrieval_passages",
    f"""SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INT) AS rank, d.text, round(cosine, 6) AS score, a.url, d.source, d.lang AS topic
        FROM (SELECT *, {_RANK.format(s='cosine')} AS rank FROM similarities QUALIFY rank <= 5) h
        JOIN documents d USING (doc_id) JOIN addresses a ON a.position = doc_id""",
)
def retrieval_passages(spark, sf_dir):
    """The best passages of each query with text, score and where they come from."""
    hits = retrieval.top_k(_topic_queries(spark, sf_dir), V.passages(spark, sf_dir), 5)
    pages = V.addresses(spark, sf_dir).select(F.col("position").alias("doc_id"), "url")
    texts = V.table(spark, sf_dir, "documents").select("doc_id", "text", "source", F.col("lang").alias("topic"))
    found = retrieval.passages(hits, texts.join(pages, "doc_id"))
    cited = [F.col("metadata")[c].alias(c) for c in ("url", "source", "topic")]
    return rounded(found.select("query_id", "rank", "text", "score", *cited))


@query(
    "metric_templates",
    f"""SELECT 'largest_rise' AS metric, subreddit, round(arg_max(crisis_rate, week) - arg_min(crisis_rate, week), 6) AS value
        FROM weekly WHERE {BETWEEN} AND crisis_rate IS NOT NULL GROUP BY subreddit
        UNION ALL
        SELECT 'volume_by_community', subreddit, CAST(sum(n_posts) AS DOUBLE) FROM weekly WHERE {BETWEEN} GROUP BY subreddit
        UNION ALL
        SELECT 'community_trend', CAST(week AS VARCHAR), CAST(n_posts AS DOUBLE) FROM weekly
        WHERE subreddit = '2-HIGH' AND {BETWEEN}""",
)
def metric_templates(spark, sf_dir):
    weekly = V.weekly(spark, sf_dir)
    span = {"first_week": WEEKS[0], "last_week": WEEKS[1]}

    def shaped(df: DataFrame, metric: str, key: str, value: str) -> DataFrame:
        return df.select(
            F.lit(metric).alias("metric"),
            F.col(key).cast("string").alias("subreddit"),
            F.round(F.col(value).cast("double"), 6).alias("value"),
        )

    rise = metrics.run_metric(weekly, "largest_rise", **span)
    volume = metrics.run_metric(weekly, "volume_by_community", **span)
    trend = metrics.run_metric(weekly, "community_trend", subreddit="2-HIGH", **span)
    return (
        shaped(rise, "largest_rise", "subreddit", "rise")
        .unionByName(shaped(volume, "volume_by_community", "subreddit", "posts"))
        .unionByName(shaped(trend, "community_trend", "week", "n_posts"))
    )


def _eval_sql(metric: str, value: str) -> str:
    def cell(kind: str) -> str:
        return f"""(SELECT round(avg({value}), 6) FROM (
            SELECT query_id, count(*) FILTER (topic = query_id) AS found,
                   any_value(size) AS relevant
            FROM (SELECT s.*, (SELECT count(*) FROM embeddings WHERE label = s.query_id) AS size FROM similarities s
                  QUALIFY {_RANK.format(s=kind)} <= 10) GROUP BY query_id))"""

    return f"SELECT '{metric}' AS metric, {cell('cosine')} AS cosine, {cell('euclidean')} AS euclidean"


@query(
    "retrieval_eval",
    _eval_sql("context_precision", "found / 10.0")
    + " UNION ALL "
    + _eval_sql("context_recall", "found / CAST(relevant AS DOUBLE)"),
)
def retrieval_eval(spark, sf_dir):
    queries, docs = _topic_queries(spark, sf_dir), V.passages(spark, sf_dir)
    backends = ["cosine", "euclidean"]
    runs = [
        pivots.search(queries, pivots.build(docs, kind), 10).withColumn("backend", F.lit(kind))
        for kind in backends
    ]
    evaluation = retrieval.evaluate(
        runs[0].unionByName(runs[1]),
        queries.select("query_id", "topic"),
        docs.select("doc_id", "topic"),
        10,
    )
    return rounded(retrieval.compare_backends(evaluation, backends))


@query(
    "question_router",
    f"""SELECT conv_id, turn, role,
               CASE WHEN trim(coalesce(question, '')) = '' THEN {S.quote(trends.HINT)}
                    WHEN {_individual("trim(question)")} THEN {S.quote(trends.REFUSAL)}
                    ELSE (SELECT answer FROM answer) END AS answer FROM questions""",
)
def question_router(spark, sf_dir):
    routed = trends.route_questions(V.questions(spark, sf_dir), V.weekly(spark, sf_dir))
    return routed.select("conv_id", "turn", "role", "answer")


# --- data quality -----------------------------------------------------------------

_CHECKED = ("post_id", "subreddit", "author", "created_date", "post")


@query(
    "dq_not_null",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS failures FROM bronze" for c in _CHECKED
    ),
)
def dq_not_null(spark, sf_dir):
    return quality.null_counts(V.bronze(spark, sf_dir), _CHECKED)


_LAYERS = {"silver": ("post_id",), "gold_posts": ("post_id",), "weekly": ("subreddit", "week")}
_NEVER_NULL = {
    "silver": ("post_id", "subreddit", "created_date", "text"),
    "gold_posts": ("post_id", "subreddit", "week", "n_words"),
    "weekly": ("subreddit", "week", "n_posts", "avg_word_count"),
}


@query(
    "dq_layers",
    " UNION ALL ".join(
        [
            f"SELECT '{t}' AS layer, '{c}' AS \"column\", 'not_null' AS test, count(*) FILTER ({c} IS NULL) AS failures FROM {t}"
            for t, columns in _NEVER_NULL.items()
            for c in columns
        ]
        + [
            f"SELECT '{t}', '{', '.join(key)}', 'unique', count(*) FROM (SELECT 1 FROM {t} GROUP BY {', '.join(key)} HAVING count(*) > 1)"
            for t, key in _LAYERS.items()
        ]
    ),
)
def dq_layers(spark, sf_dir):
    """not_null and unique on Silver and both Gold tables."""
    silver = V.stored_silver(spark, sf_dir)
    tables = {"silver": silver, "gold_posts": gold.gold_posts(silver), "weekly": V.weekly(spark, sf_dir)}
    parts = []
    for name, df in tables.items():
        nulls = quality.null_counts(df, _NEVER_NULL[name])
        parts.append(nulls.select(F.lit(name).alias("layer"), "column", F.lit("not_null").alias("test"), "failures"))
        key = _LAYERS[name]
        twice = quality.duplicate_keys(df, *key).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(twice.select(F.lit(name).alias("layer"), F.lit(", ".join(key)).alias("column"), F.lit("unique").alias("test"), "failures"))
    return reduce(DataFrame.unionByName, parts)


_BOUNDS = {"silver": {}, "gold_posts": {"n_words": (2, 900)}, "weekly": {"crisis_rate": (0.0, 0.4)}}
_KNOWN = {"silver": {"subreddit": SOURCES[:10]}, "gold_posts": {}, "weekly": {"subreddit": V.COMMUNITIES[:3]}}


@query(
    "dq_on_write",
    " UNION ALL ".join(
        [f"SELECT '{t}' AS layer, '*' AS \"column\", 'rows' AS test, count(*) AS failures FROM {t}" for t in _LAYERS]
        + [f"SELECT '{t}', '{c}', 'not_null', count(*) FILTER ({c} IS NULL) FROM {t}" for t, columns in _NEVER_NULL.items() for c in columns]
        + [f"SELECT '{t}', '{c}', 'bounds', count(*) FILTER ({c} NOT BETWEEN {low} AND {high}) FROM {t}" for t, b in _BOUNDS.items() for c, (low, high) in b.items()]
        + [f"SELECT '{t}', '{c}', 'accepted', count(*) FILTER ({c} NOT IN ({S.values(v)})) FROM {t}" for t, k in _KNOWN.items() for c, v in k.items()]
    ),
)
def dq_on_write(spark, sf_dir):
    """The row checks of all layers, each counted by the job that writes the layer."""
    tables = {"silver": V.silver(spark, sf_dir), "gold_posts": V.gold_posts(spark, sf_dir), "weekly": V.weekly(spark, sf_dir)}
    parts = []
    for name, df in tables.items():
        rules = quality.Rules(_NEVER_NULL[name], _BOUNDS[name], _KNOWN[name])
        path = scratch_dir(spark, f"checked-{name}")
        parts.append(quality.write_checked(df, rules, lambda rows, path=path: rows.write.parquet(path)).withColumn("layer", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query("dq_unique", "SELECT post_id, count(*) AS n FROM bronze GROUP BY post_id HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return quality.duplicate_keys(V.bronze(spark, sf_dir), "post_id")


_ACCEPTED = SOURCES[:10]


@query(
    "dq_accepted_values",
    f"SELECT subreddit, count(*) AS n FROM bronze WHERE subreddit NOT IN ({S.values(_ACCEPTED)}) GROUP BY subreddit",
)
def dq_accepted_values(spark, sf_dir):
    return quality.unexpected_values(V.bronze(spark, sf_dir), "subreddit", _ACCEPTED)


def _leak_sql() -> str:
    """Rows of the raw posts that the scrub of each kind would change."""
    checks = {
        "email": S.email("post"),
        "url": S.url("post"),
        "handle": S.handle("post"),
        "mention": S.mention("post"),
        "phone": S.phone("post"),
    }
    counts = ", ".join(
        f"count(*) FILTER ({scrubbed} <> post) AS post_{kind}" for kind, scrubbed in checks.items()
    )
    return f"""SELECT count(*) AS rows, {counts},
        (SELECT count(DISTINCT author_hash) FROM (SELECT {_LEAK} AS author_hash FROM bronze)
         WHERE author_hash IN (SELECT author FROM bronze)) AS author_collisions FROM bronze"""


@query("leak_report", _leak_sql())
def leak_report(spark, sf_dir):
    """What the checks find in a layer that was not scrubbed."""
    posts = V.bronze(spark, sf_dir)
    broken = _leaky(spark, sf_dir)
    joined = posts.select("post", F.lit(None).cast("string").alias("author_hash"))
    report = sv.leak_report(joined, sv.distinct_authors(posts), ("post",))
    collisions = sv.leaked_hashes(broken, sv.distinct_authors(posts)).agg(F.count(F.lit(1)))
    return report.withColumn("author_collisions", collisions.scalar())


@query(
    "assert_anonymized",
    "SELECT count(*) AS rows, "
    + ", ".join(
        f"CAST(0 AS BIGINT) AS {c}"
        for c in (*(f"text_{kind}" for kind in T.PII_PATTERNS), "author_collisions")
    )
    + " FROM silver",
)
def assert_anonymized(spark, sf_dir):
    """The guard lets a clean layer pass, with every count zero."""
    counts = sv.assert_anonymized(V.stored_silver(spark, sf_dir), sv.distinct_authors(V.bronze(spark, sf_dir)))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))


@query(
    "dq_bounds",
    """SELECT 'sentiment' AS "column", count(*) FILTER (sentiment NOT BETWEEN -0.02 AND 0.02) AS failures FROM weekly
       UNION ALL SELECT 'crisis_rate', count(*) FILTER (crisis_rate NOT BETWEEN 0 AND 0.4) FROM weekly""",
)
def dq_bounds(spark, sf_dir):
    """Bounds tighter than the contract's, so that some rows fail."""
    bounds = {"sentiment": (-0.02, 0.02), "crisis_rate": (0.0, 0.4)}
    return quality.out_of_bounds(V.weekly(spark, sf_dir), bounds)
