"""Weekly Gold kept up to date batch by batch: only the weeks that a batch touches are rolled up again.

Posts are stored by span and batch; a span is a week, or a month, quarter or year
where weeks hold too little to be folders of their own. Each (span, batch) has partial
results that can be added up: sums and counts by community and week, and its distinct
authors. A week's row is made of the partials of all its batches. Every write replaces
whole partitions by what a batch holds, so a batch that is run again, after a failure
too, changes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from moodtide.functions.numbers import round_even
from moodtide.operators.gold import unique_scores
from moodtide.schemas import GOLD_POSTS, GOLD_WEEKLY, conform
from moodtide.session import materialize
from moodtide.sources import layers

SUMS = (
    "subreddit string, n_posts long, words double, n_words long, sentiment double, n_scored long, crisis_count long, "
    "week date, span date, batch string"
)
AUTHORS = "subreddit string, author_hash string, week date, span date, batch string"
SPAN = StructField("span", DateType())
POSTS = StructType([*GOLD_POSTS.fields, SPAN, StructField("batch", StringType())])
WEEKLY = StructType([*GOLD_WEEKLY.fields, SPAN])


def _write(df: DataFrame, path: str, *by: str) -> None:
    """Replaces the partitions that ``df`` has rows of."""
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def _within(parts: list[tuple]) -> Column:
    """Rows of these (span, batch); both are folders, so the scan reads no others."""
    spans: dict[str, list] = {}
    for span, batch in parts:
        spans.setdefault(batch, []).append(span)
    chosen = F.lit(False)
    for batch, own in spans.items():
        chosen = chosen | ((F.col("batch") == batch) & F.col("span").isin(own))
    return chosen


def add_batch(posts: DataFrame, root: str, batch: str, span: str = "week") -> list:
    """Stores a batch of per-post rows (``GOLD_POSTS``) and renews its spans; returns their first days.

    A batch names its posts: given again, it replaces what it held. All batches of a
    table take the same ``span``. Posts without a community or a week are left out, as
    the roll-up leaves them out.
    """
    spark = posts.sparkSession
    held = {p[0] for p in _parts(spark, root) if p[1] == batch}
    known = posts.where(F.col("subreddit").isNotNull() & F.col("week").isNotNull())
    rows = known.select(*conform(GOLD_POSTS)).withColumns({"span": F.trunc("week", span), "batch": F.lit(batch)})
    rows = materialize(rows, "batch")
    spans = {r[0] for r in rows.select("span").distinct().collect()}  # of the calendar: a few hundred
    _write(rows.select(*POSTS.names), f"{root}/posts", "span", "batch")
    gone = held - spans
    for day in gone:
        for table in ("posts", "sums", "authors"):
            layers.discard(spark, f"{root}/{table}", f"span={day}/batch={batch}")
    _renew(spark, root, [(day, batch) for day in sorted(spans)], gone)
    return sorted(spans | gone)


def rescore(spark: SparkSession, root: str, scores: DataFrame, columns: tuple[str, ...]) -> list:
    """Puts scores, unique by post, in the place of the old ones; renews the spans of the posts they are for, and returns those.

    A post without a new score keeps its own.
    """
    posts = read_posts(spark, root)
    hit = posts.join(scores.select("post_id").distinct(), "post_id", "left_semi").select("span", "batch").distinct()
    parts = sorted((r["span"], r["batch"]) for r in hit.collect())
    if not parts:
        return []
    fresh = unique_scores(scores, *columns).withColumn("_new", F.lit(True))
    fresh = fresh.withColumnsRenamed({c: f"_{c}" for c in columns})
    merged = posts.where(_within(parts)).join(fresh, "post_id", "left")
    new = {c: F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    _write(materialize(merged.withColumns(new).select(*POSTS.names), "rescored"), f"{root}/posts", "span", "batch")
    _renew(spark, root, parts, set())
    return sorted({day for day, _ in parts})


def _renew(spark: SparkSession, root: str, parts: list[tuple], emptied: set) -> None:
    """Partials of these (span, batch), then the rows of their spans."""
    if parts:
        own = read_posts(spark, root).where(_within(parts))
        sums = own.groupBy("subreddit", "week", "span", "batch").agg(
            F.count("post_id").alias("n_posts"),
            F.sum(F.col("n_words").cast("double")).alias("words"),
            F.count("n_words").alias("n_words"),
            F.sum("sentiment_score").alias("sentiment"),
            F.count("sentiment_score").alias("n_scored"),
            F.sum(F.col("crisis_flag").cast("long")).alias("crisis_count"),
        )
        _write(sums.select(*_names(SUMS)), f"{root}/sums", "span", "batch")
        authors = own.where("author_hash is not null").select(*_names(AUTHORS)).distinct()
        _write(authors, f"{root}/authors", "span", "batch")
    spans = sorted({day for day, _ in parts} | emptied)
    if not spans:
        return
    _write(_rolled(spark, root, F.col("span").isin(spans)), f"{root}/weekly", "span")
    left = {day for day, _ in _parts(spark, root)}
    for day in emptied - left:
        layers.discard(spark, f"{root}/weekly", f"span={day}")


def _rolled(spark: SparkSession, root: str, chosen: Column) -> DataFrame:
    """Weekly rows out of partials. Authors are counted apart, a week's batches may share some."""
    added = _read(spark, f"{root}/sums", SUMS).where(chosen).groupBy("subreddit", "week", "span").agg(
        F.sum("n_posts").alias("n_posts"),
        round_even(F.try_divide(F.sum("words"), F.sum("n_words")), 2).alias("avg_word_count"),
        F.try_divide(F.sum("sentiment"), F.sum("n_scored")).alias("sentiment"),
        F.sum("crisis_count").alias("crisis_count"),
    )
    authors = _read(spark, f"{root}/authors", AUTHORS).where(chosen)
    active = authors.groupBy("subreddit", "week").agg(F.count_distinct("author_hash").alias("n_active_authors"))
    both = added.join(active, ["subreddit", "week"], "left").withColumn("n_active_authors", F.coalesce("n_active_authors", F.lit(0)))
    rated = both.withColumn("crisis_rate", F.try_divide("crisis_count", "n_posts"))
    return rated.select(*conform(GOLD_WEEKLY), "span")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    if layers.has_parquet(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _parts(spark: SparkSession, root: str) -> list[tuple]:
    """The (span, batch) stored; only the names of folders are read."""
    return [tuple(r) for r in read_posts(spark, root).select("span", "batch").distinct().collect()]


def read_posts(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/posts", POSTS)


def read_weekly(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/weekly", WEEKLY).select(*conform(GOLD_WEEKLY))
