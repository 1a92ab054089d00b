"""Bronze, Silver and Gold on small dirty inputs; sinks; whole runs."""

import datetime as dt
import hashlib
import os
from collections import defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from moodtide.operators import gold, quality, silver as sv
from moodtide.plans import medallion, scoring as scoring_plan
from moodtide.operators import scoring
from moodtide.schemas import (
    BRONZE,
    GOLD_POSTS,
    GOLD_POSTS_REQUIRED,
    GOLD_WEEKLY,
    SILVER,
    SENTIMENT_SCORES,
)
from moodtide.session import scratch_dir
from moodtide.sources import landing, layers
from moodtide.streaming import incremental

SALT = "pepper and salt"
AUTHORS = ("lee_park", "kim_w", "ola")
NOW = dt.datetime(2023, 9, 3)

# What the rows exercise: a post in two periods (the lower period stays), identifiers
# of three kinds, a post without author, both removal markers, blanks, no text, two bad dates.
WALK = "Walked  twice\tthis\nMonday"


def bronze_rows():
    rows = [
        ("m1", "sleep", "lee_park", "2021/05/10", WALK, "pre"),
        ("m1", "sleep", "lee_park", "2021/05/10", WALK, "2020"),
        ("m2", "sleep", "kim_w", "2021/05/16", "Write x.y@mail.example or /u/lee_park", "pre"),
        ("m3", "running", None, "2021/06/02", "A  slow day, http://run.example/42 has it", "post"),
        ("m4", "running", "ola", "2021/06/03", " [removed] ", "post"),
        ("m5", "sleep", "ola", "2021/06/03", "[deleted]", "pre"),
        ("m6", "sleep", "ola", "2021/06/04", "\t \n", "pre"),
        ("m7", "sleep", "ola", "2021/06/04", None, "pre"),
        ("m8", "sleep", "ola", "2021/13/04", "month thirteen", "pre"),
        ("m9", "sleep", "ola", None, "no day at all", "pre"),
    ]
    return [(i, s, a, d, p, w, f"{s}_{w}.csv", NOW) for i, s, a, d, p, w in rows]


@pytest.fixture(scope="module")
def bronze(spark):
    return spark.createDataFrame(bronze_rows(), BRONZE)


@pytest.fixture(scope="module")
def silver(bronze):
    return sv.bronze_to_silver(bronze, SALT)


def test_silver_rows_and_schema(silver):
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    rows = {r["post_id"]: r for r in silver.collect()}
    assert set(rows) == {"m1", "m2", "m3"}
    assert rows["m1"]["period"] == "2020" and rows["m1"]["text"] == "Walked twice this Monday"
    assert rows["m1"]["author_hash"] == hashlib.sha256(f"{SALT}:lee_park".encode()).hexdigest()
    assert rows["m3"]["author_hash"] is None
    blob = str(rows)
    for secret in (*AUTHORS, "x.y@mail", "run.example"):
        assert secret not in blob


def test_audit(bronze):
    assert sv.drop_audit(bronze).first().asDict() == {
        "empty_or_deleted_text": 4,
        "unparseable_date": 2,
        "duplicate_post_id": 1,
    }


def test_result_does_not_depend_on_partitioning(bronze, silver):
    shuffled = sv.bronze_to_silver(bronze.orderBy(F.rand(3)).repartition(5), SALT)
    assert sorted(shuffled.collect()) == sorted(silver.collect())


def test_salt_is_required_and_never_in_a_plan(bronze, silver):
    with pytest.raises(ValueError, match="salt"):
        sv.bronze_to_silver(bronze, "")
    for mode in ("simple", "extended", "formatted", "codegen"):
        plan = silver._sc._jvm.PythonSQLUtils.explainString(silver._jdf.queryExecution(), mode)
        assert SALT not in plan


def test_hot_key_is_cut_before_the_shuffle(bronze, plan_of):
    plan = plan_of(sv.bronze_to_silver(bronze, SALT))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert "Python" not in plan


def test_missing_and_empty_authors_have_no_hash(spark):
    rows = [("a", None), ("b", ""), ("c", "x")]
    df = sv.anonymize_frame(spark.createDataFrame(rows, "post_id string, author string"), SALT)
    got = {r["post_id"]: r["author_hash"] for r in df.collect()}
    assert got["a"] is None and got["b"] is None and len(got["c"]) == 64


def test_anonymize_frame_drops_identifiers(spark):
    df = spark.createDataFrame(
        [("q", "kim_w", "t9", "to c.d@site.example now")],
        "post_id string, author string, author_fullname string, post string",
    )
    out = sv.anonymize_frame(df, SALT)
    assert out.columns == ["post_id", "post", "author_hash"]
    assert out.first()["post"] == "to [REDACTED:email] now"


def test_verification(spark, bronze, silver):
    authors = sv.distinct_authors(bronze)
    sv.assert_anonymized(silver, authors)
    assert set(sv.assert_anonymized(silver, authors).values()) == {0, 3}
    unhashed = silver.withColumns({"author_hash": F.lit("kim_w"), "author": F.lit("kim_w")})
    with pytest.raises(AssertionError, match=r"author_collisions \(1 rows\), column author \(3 rows\)"):
        sv.assert_anonymized(unhashed, authors)
    unscrubbed = silver.withColumn("text", F.lit("see www.a.example or b@c.example"))
    with pytest.raises(AssertionError, match=r"text_email \(3 rows\), text_url \(3 rows\)"):
        sv.assert_anonymized(unscrubbed, authors)


def test_gold_features(silver):
    posts = gold.gold_posts(silver)
    assert posts.schema.names == GOLD_POSTS.names
    walk = posts.where("post_id = 'm1'").first()
    assert (walk["n_words"], walk["n_chars"]) == (4, len("Walked twice this Monday"))
    assert walk["week"] == dt.date(2021, 5, 10)
    unscored = posts.where(
        "sentiment_score IS NULL AND sentiment_label IS NULL AND crisis_score IS NULL AND crisis_flag IS NULL"
    )
    assert unscored.count() == 3


def test_weekly_unscored_is_null(silver):
    weekly = gold.weekly_rollup(gold.gold_posts(silver))
    assert weekly.schema.names == GOLD_WEEKLY.names
    assert weekly.where("subreddit = 'running'").first()["n_active_authors"] == 0
    row = weekly.where("subreddit = 'sleep'").first()
    assert (row["n_posts"], row["n_active_authors"]) == (2, 2)
    assert row["sentiment"] is None and row["crisis_count"] is None and row["crisis_rate"] is None


def test_weekly_leaves_out_unknown_communities(spark, silver):
    posts = gold.gold_posts(silver)
    lost = posts.withColumn("subreddit", F.lit(None).cast("string"))
    weekly = gold.weekly_rollup(posts.unionByName(lost))
    assert weekly.agg(F.sum("n_posts")).first()[0] == posts.count()


def test_distinct_authors_of_a_hot_week_are_spread(spark, plan_of):
    rows = spark.range(30000).select(
        F.col("id").cast("string").alias("post_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("subreddit"),
        F.lit(dt.date(2020, 1, 6)).alias("week"),
        F.sha2(F.col("id").cast("string"), 256).alias("author_hash"),
        F.lit(5).alias("n_words"),
        F.lit(None).cast("double").alias("sentiment_score"),
        F.lit(None).cast("boolean").alias("crisis_flag"),
    )
    weekly = gold.weekly_rollup(rows)
    assert "hashpartitioning(subreddit" in plan_of(weekly)
    first = plan_of(weekly).rindex("Exchange hashpartitioning")
    assert "author_hash" in plan_of(weekly)[first : first + 120]
    assert weekly.where("subreddit = 'hot'").first()["n_active_authors"] == 10000


def test_scores_merge_left_and_refuse_duplicates(spark, silver):
    posts = gold.gold_posts(silver)
    scores = spark.createDataFrame([("m1", 0.25, "positive")], SENTIMENT_SCORES)
    merged = gold.apply_scores(posts, scores, gold.SENTIMENT_COLUMNS)
    assert merged.columns == posts.columns
    got = {r["post_id"]: r["sentiment_score"] for r in merged.collect()}
    assert got == {"m1": 0.25, "m2": None, "m3": None}
    with pytest.raises(PySparkException, match="more than one score"):
        gold.apply_scores(posts, scores.union(scores), gold.SENTIMENT_COLUMNS).collect()


def test_bucketed_tables_merge_without_a_shuffle(spark, silver, plan_of):
    posts = gold.gold_posts(silver)
    layers.save_bucketed(posts, "bucketed_posts", buckets=4)
    layers.save_bucketed(
        spark.createDataFrame([("m1", 0.25, "positive")], SENTIMENT_SCORES), "bucketed_scores", buckets=4
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = gold.apply_scores(
            spark.table("bucketed_posts"), spark.table("bucketed_scores"), gold.SENTIMENT_COLUMNS
        )
        assert "Exchange" not in plan_of(merged)
        assert merged.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_posts")
        spark.sql("DROP TABLE bucketed_scores")


# --- landing ----------------------------------------------------------------------


@pytest.fixture()
def corpus_dir(tmp_path):
    header = "flesch,subreddit,author,date,post,tfidf_x\n"
    body = (
        '1.0,anxiety,jane_doe,2019/01/07,"first, ""quoted""\nsecond line",0.1\n'
        "2.0,anxiety,,2019/01/08,NA,0.2\n"
    )
    (tmp_path / "anxiety_PRE_a+b c%d_posts.csv").write_text(header + body)
    parts = tmp_path / "depression_post_posts.csv"
    parts.mkdir()
    for i in range(2):
        (parts / f"part-{i}.csv").write_text(header + f"1,depression,a{i},2020/02/0{i + 1},text {i},0\n")
    return str(tmp_path)


def test_land_csv(spark, corpus_dir):
    rows = landing.land_csv(spark, corpus_dir)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in BRONZE]
    found = {r["post"]: r for r in rows.collect()}
    first = found['first, "quoted"\nsecond line']
    assert first["source_file"] == "anxiety_PRE_a+b c%d_posts.csv" and first["period"] == "pre"
    expected = 'anxiety|jane_doe|2019/01/07|first, "quoted"\nsecond line'
    assert first["post_id"] == hashlib.sha1(expected.encode()).hexdigest()[:16]
    assert found["NA"]["author"] is None
    assert {found["text 0"]["source_file"], found["text 1"]["source_file"]} == {"depression_post_posts.csv"}


def test_csv_scan_reads_four_columns(spark, corpus_dir, plan_of):
    scan = [line for line in plan_of(landing.land_csv(spark, corpus_dir)).split("\n") if "FileScan csv" in line]
    assert "flesch" not in scan[0] and "tfidf_x" not in scan[0]


def test_catalog(spark):
    keys = ["anxiety_pre_posts.csv", "anxiety_post_posts.csv", "depression_post_posts.csv"]
    catalog = spark.createDataFrame([(k,) for k in keys], "key string")
    picked = landing.select_files(landing.wanted_pairs(spark, ["Anxiety"], ["pre", "post"]), catalog)
    assert [r["key"] for r in picked.collect()] == keys[:2]
    many = [f"c{i:02d}" for i in range(25)]
    with pytest.raises(ValueError) as lost:
        landing.select_files(landing.wanted_pairs(spark, many, ["pre"]), catalog)
    assert all(f"('{c}', 'pre')" in str(lost.value) for c in many)
    other = landing.wanted_pairs(spark, ["Sleep"], ["Pre"], suffix="_features.csv").first()
    assert (other["expected"], other["file_subreddit"]) == ("Sleep_Pre_features.csv", "sleep")


def test_expected_files(spark, corpus_dir):
    files = landing.list_files(spark, corpus_dir)
    wanted = landing.wanted_pairs(spark, ["depression"], ["post"])
    assert landing.require_files(wanted, files).first()["n_files"] == 2
    many = [f"c{i:02d}" for i in range(25)]
    with pytest.raises(FileNotFoundError) as lost:
        landing.require_files(landing.wanted_pairs(spark, many, ["pre"]), files)
    assert all(f"{c}_pre_posts.csv" in str(lost.value) for c in many)


def test_empty_files_are_listed(spark, tmp_path):
    (tmp_path / "a b_pre_posts.csv").write_text("")
    (tmp_path / "c_pre_posts.csv").write_text("x")
    files = {r["name"]: r["length"] for r in landing.list_files(spark, str(tmp_path)).collect()}
    assert files == {"a b_pre_posts.csv": 0, "c_pre_posts.csv": 1}
    wanted = landing.wanted_pairs(spark, ["a b"], ["pre"])
    assert landing.require_files(wanted, landing.list_files(spark, str(tmp_path))).first()["n_files"] == 1
    assert {r["md5"] for r in landing.file_digests(spark, str(tmp_path)).where("length = 0").collect()} == {hashlib.md5(b"").hexdigest()}


def test_checks_run_with_the_write(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("p1", "sleep", 3), ("p2", None, 50), (None, "golf", None), ("p4", "adhd", 7)], "post_id string, subreddit string, n_words int").repartition(3)
    rules = quality.Rules(["post_id", "n_words"], {"n_words": (1, 10)}, {"subreddit": ["sleep", "adhd"]})
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    path = str(tmp_path / "w")
    verdict = quality.write_checked(df.mapInArrow(count, df.schema), rules, lambda rows: rows.write.parquet(path))
    got = {(r["column"], r["test"]): r["failures"] for r in verdict.collect()}
    assert got == {("*", "rows"): 4, ("post_id", "not_null"): 1, ("n_words", "not_null"): 1, ("n_words", "bounds"): 1, ("subreddit", "accepted"): 1}
    assert computed.value == 4 == spark.read.parquet(path).count()  # no row was computed twice
    apart = {r["column"]: r["failures"] for r in quality.null_counts(df, ["post_id", "n_words"]).collect()}
    assert apart == {"post_id": 1, "n_words": 1}
    layers.publish_checked(df.where("post_id = 'p1'"), root, rules)
    with pytest.raises(AssertionError, match=r"n_words bounds \(1 rows\)"):
        layers.publish_checked(df, root, rules)
    assert spark.read.parquet(f"{root}/{layers.current_version(spark, root)}").count() == 1
    assert len([f for f in os.listdir(root) if f.startswith("v")]) == 1
    assert quality.write_checked(df.limit(0), quality.Rules(["post_id"]), lambda rows: rows.write.parquet(str(tmp_path / "e"))).where("failures > 0").count() == 0


def test_bucketed_merge_query_shuffles_neither_side(spark, plan_of):
    from moodtide.bindings import queries as registry

    plan = plan_of(registry.QUERIES["bucketed_merge"](spark, "/root/testdata/sf0.001"))
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


@pytest.fixture
def hot_corpus(spark, tmp_path):
    """Three corpus files as folders of part files of 50 rows; the first holds a third of all rows and more."""
    rows = spark.range(3000).selectExpr("id", "concat('text ', id) AS post", "CASE WHEN id % 3 = 0 THEN 'hot_pre_posts.csv' ELSE concat('c', id % 7, '_pre_posts.csv') END AS source_file")
    path = str(tmp_path / "corpus")
    rows.repartition(4).write.partitionBy("source_file").option("maxRecordsPerFile", 50).option("header", True).csv(path)
    return path


def test_roots_of_part_files(spark, hot_corpus, tmp_path, plan_of):
    parts = landing.part_digests(landing.file_digests(spark, hot_corpus)).where("part LIKE '%.csv'")
    roots = {r["key"]: r for r in landing.digest_roots(parts).collect()}
    assert len(roots) == 8 and roots["hot_pre_posts.csv"]["n_parts"] >= 20
    leaves = defaultdict(list)
    for r in parts.where("key = 'hot_pre_posts.csv'").collect():
        leaves[hashlib.md5(r["part"].encode()).hexdigest()[:3]].append(f"{r['part']}:{r['length']}:{r['md5']}")
    inner = sorted(f"{n}:{hashlib.md5(chr(10).join(sorted(x)).encode()).hexdigest()}" for n, x in leaves.items())
    assert roots["hot_pre_posts.csv"]["md5"] == hashlib.md5("\n".join(inner).encode()).hexdigest()
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a_pre_posts.csv").write_bytes(b"x,y\n")
    plain = landing.digest_roots(landing.part_digests(landing.file_digests(spark, str(tmp_path / "plain")))).first()
    assert (plain["key"], plain["n_parts"], plain["md5"]) == ("a_pre_posts.csv", 1, hashlib.md5(b"x,y\n").hexdigest())


def test_a_flipped_byte_in_one_part_is_found(spark, hot_corpus):
    read = lambda: landing.part_digests(landing.file_digests(spark, hot_corpus)).where("part LIKE '%.csv'")
    stored = spark.createDataFrame(read().collect(), read().schema)
    assert {r["status"] for r in landing.verify_parts(read(), stored).collect()} == {"verified"}
    folder = f"{hot_corpus}/source_file=hot_pre_posts.csv"
    files = sorted(f for f in os.listdir(folder) if f.endswith(".csv"))
    with open(f"{folder}/{files[3]}", "r+b") as f:
        f.seek(20)
        byte = f.read(1)
        f.seek(20)
        f.write(bytes([byte[0] ^ 1]))
    os.remove(f"{folder}/{files[5]}")
    os.remove(f"{folder}/.{files[3]}.crc")
    open(f"{hot_corpus}/source_file=c1_pre_posts.csv/part-new.csv", "w").write("x")
    got = {r["key"]: tuple(r)[1:] for r in landing.verify_parts(read(), stored).collect()}
    assert got.pop("hot_pre_posts.csv") == ("mismatch", 1, 1, 0) and got.pop("c1_pre_posts.csv") == ("mismatch", 0, 0, 1)
    assert set(got.values()) == {("verified", 0, 0, 0)}
    keys = spark.createDataFrame([("hot_pre_posts.csv",)], "key string")
    assert {(r["part"], r["change"]) for r in landing.changed_parts(read(), stored, keys).collect()} == {(files[3], "changed"), (files[5], "lost")}


def test_digests_and_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x" * 3_000_000)
    (tmp_path / "b %b.csv").write_bytes(b"y")
    files = landing.file_digests(spark, str(tmp_path)).withColumnRenamed("name", "key")
    manifest = spark.createDataFrame(
        [
            ("a.csv", hashlib.md5(b"x" * 3_000_000).hexdigest()),
            ("b %b.csv", "0" * 32),
            ("c.csv", "0" * 32),
        ],
        "key string, md5 string",
    )
    status = {r["key"]: r["status"] for r in landing.verify_checksums(files, manifest).collect()}
    assert status == {"a.csv": "verified", "b %b.csv": "mismatch", "c.csv": "missing"}


def test_bronze_partitions_are_replaced_one_by_one(spark, bronze, tmp_path):
    path = str(tmp_path / "bronze")
    counts = {r["source_file"]: r["n_rows"] for r in layers.write_bronze(bronze, path).collect()}
    assert counts == {"sleep_pre.csv": 7, "sleep_2020.csv": 1, "running_post.csv": 2}
    layers.write_bronze(bronze.where("period = '2020'").withColumn("post", F.lit("new")), path)
    again = layers.read_bronze(spark, path)
    assert again.count() == 10 and again.where("post = 'new'").count() == 1
    with pytest.raises(FileNotFoundError):
        layers.read_bronze(spark, str(tmp_path / "nothing"))


# --- layers -----------------------------------------------------------------------


def test_publish_and_rewrite_from_itself(spark, tmp_path):
    root = str(tmp_path / "layer")
    assert layers.publish(spark.range(5), root).startswith("v000001-")
    schema = spark.range(1).schema
    doubled = layers.read_layer(spark, root, schema)
    assert layers.publish(doubled.union(doubled), root).startswith("v000002-")
    assert layers.read_layer(spark, root, schema).count() == 10
    assert sorted(p.name for p in tmp_path.joinpath("layer").iterdir() if p.name.startswith("_")) == ["_CURRENT"]
    assert layers.next_version(spark, root) != layers.next_version(spark, root)


def test_failed_publish_keeps_the_old_version(spark, tmp_path):
    root = str(tmp_path / "layer")
    layers.publish(spark.range(5), root)
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        layers.publish(broken, root)
    assert layers.read_layer(spark, root, spark.range(1).schema).count() == 5


def test_empty_build_does_not_replace(spark, tmp_path):
    root = str(tmp_path / "docs")
    assert layers.replace_if_any(spark.range(3), root)
    assert not layers.replace_if_any(spark.range(0), root)
    assert layers.read_layer(spark, root, spark.range(1).schema).count() == 3


def test_warehouse_load(spark, silver, tmp_path):
    posts = gold.gold_posts(silver)
    loaded = layers.load_table(posts, GOLD_POSTS, GOLD_POSTS_REQUIRED, str(tmp_path / "w"))
    assert layers.verify_counts(posts, loaded).first()["matches"]
    lost = posts.withColumn("n_words", F.lit(None).cast("bigint"))
    with pytest.raises(PySparkException, match="n_words"):
        layers.load_table(lost, GOLD_POSTS, GOLD_POSTS_REQUIRED, str(tmp_path / "x"))


def test_source_fallback(spark, silver, tmp_path):
    weekly = gold.weekly_rollup(gold.gold_posts(silver))
    assert layers.weekly_source(spark, str(tmp_path / "none"), weekly)[0] == layers.FALLBACK
    # Staged but never published, and another table that is: still the fallback.
    layers.stage(weekly, f"{tmp_path}/gold/{layers.WEEKLY_TABLE}")
    layers.publish(gold.gold_posts(silver), f"{tmp_path}/gold/{layers.POSTS_TABLE}")
    assert layers.weekly_source(spark, f"{tmp_path}/gold", weekly)[0] == layers.FALLBACK
    layers.publish(weekly, f"{tmp_path}/gold/{layers.WEEKLY_TABLE}")
    label, live = layers.weekly_source(spark, f"{tmp_path}/gold", weekly)
    assert label == layers.LIVE and live.count() == 2


# --- whole runs -------------------------------------------------------------------


def test_medallion_and_scoring_run(spark, bronze, tmp_path):
    root = str(tmp_path)
    report = medallion.run(bronze, root, SALT).first()
    assert (report["bronze_rows"], report["raw_authors"], report["silver_rows"]) == (10, 3, 3)
    assert (report["weeks"], report["communities"], report["quarantined"]) == (2, 2, 0)
    calls = []

    def score(posts):
        calls.append(posts.count())
        return scoring.score_with_lexicon(posts, ("twice",), ("slow",))

    scoring_plan.score_sentiment(spark, root, score)
    scoring_plan.score_sentiment(spark, root, score)
    assert calls == [3, 0]
    scores = {r["post_id"]: r["sentiment_score"] for r in medallion.read_posts(spark, root).collect()}
    assert scores == {"m1": 0.5, "m2": 0.0, "m3": -0.5}
    weekly = medallion.read_weekly(spark, root)
    assert weekly.where("sentiment IS NULL").count() == 0
    assert weekly.agg(F.sum("n_posts")).first()[0] == 3


def test_leak_stops_the_run(spark, bronze, tmp_path, monkeypatch):
    monkeypatch.setattr(sv, "bronze_to_silver", lambda b, s: b.select(
        "post_id", "subreddit", F.lit(None).cast("date").alias("created_date"),
        F.col("author").alias("author_hash"), F.col("post").alias("text"),
        "period", "source_file", "ingested_at"))
    with pytest.raises(AssertionError, match="author_collisions"):
        medallion.run(bronze, str(tmp_path), SALT)
    assert layers.current_version(spark, medallion.silver_path(str(tmp_path))) is None
    assert not list(tmp_path.rglob("*.parquet"))


def test_glued_identifiers_go_to_quarantine(spark, bronze, tmp_path):
    """Cutting the number out makes a mention of what follows; the run goes on without that post."""
    odd = spark.createDataFrame([("m0", "sleep", "ola", "2021/05/11", "try 5550001111@rest then", "pre", "sleep_pre.csv", NOW)], BRONZE)
    report = medallion.run(bronze.unionByName(odd), str(tmp_path), SALT).first()
    assert (report["silver_rows"], report["quarantined"]) == (3, 1)
    assert medallion.read_silver(spark, str(tmp_path)).where("post_id = 'm0'").count() == 0
    kept = medallion.read_quarantine(spark, str(tmp_path))
    assert [r["post_id"] for r in kept.collect()] == ["m0"] and "text" not in kept.columns
    everything = spark.read.parquet(f"{medallion.silver_path(str(tmp_path))}/v*")
    assert everything.where("text LIKE '%@rest%'").count() == 0


def test_incremental_landing(spark, corpus_dir, tmp_path):
    out, mark = str(tmp_path / "bronze_out"), str(tmp_path / "mark")
    header = "flesch string, subreddit string, author string, date string, post string, tfidf_x string"
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(header)
    source = scratch_dir(spark, "landing")
    import shutil

    shutil.copytree(corpus_dir, source, ignore=shutil.ignore_patterns("bronze_out", "mark"))
    incremental.land_new_files(spark, source, out, mark, schema).awaitTermination()
    assert layers.read_bronze(spark, out).count() == 4
    with open(f"{source}/adhd_pre_posts.csv", "w") as new:
        new.write("flesch,subreddit,author,date,post,tfidf_x\n1,adhd,z,2020/01/01,new post,0\n")
    incremental.land_new_files(spark, source, out, mark, schema).awaitTermination()
    assert layers.read_bronze(spark, out).count() == 5


# --- quality ----------------------------------------------------------------------


def test_quality_checks(spark, bronze):
    nulls = {r["column"]: r["failures"] for r in quality.null_counts(bronze, ["post_id", "post"]).collect()}
    assert nulls == {"post_id": 0, "post": 1}
    assert [tuple(r) for r in quality.duplicate_keys(bronze, "post_id").collect()] == [("m1", 2)]
    assert quality.duplicate_keys(bronze, "post_id", "period").count() == 0
    odd = quality.unexpected_values(bronze, "subreddit", ["sleep"])
    assert [tuple(r) for r in odd.collect()] == [("running", 2)]
    values = spark.createDataFrame([(0.5,), (1.5,), (None,)], "v double")
    assert quality.out_of_bounds(values, {"v": (-1, 1)}).first()["failures"] == 1


def test_reconcile(spark, bronze):
    same = quality.reconcile(bronze, bronze, "subreddit", "created_date")
    assert same.where("NOT matches").count() == 0
    fewer = quality.reconcile(bronze, bronze.where("subreddit = 'sleep'"), "subreddit", "created_date")
    assert [r["subreddit"] for r in fewer.where("NOT matches").collect()] == ["running"]
