"""Inputs of the registered queries, derived row by row from the given tables.

Every view covers its whole table; each has a twin in ``sql.py``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moodtide.functions.text import derive_post_id, hash_author, url_host
from moodtide.operators import corpus, gold, scoring, signal, silver as sv
from moodtide.session import materialize
from moodtide.sources.landing import FILE_SUFFIX

SALT = "fixture-salt"
CUTOFF = dt.date(1998, 3, 11)
FIRST_DAY = dt.date(2019, 1, 1)
LANDED_AT = dt.datetime(2024, 1, 1)
RETRIEVED_AT = "2024-01-01T00:00:00+00:00"
COMMUNITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

# Vocabulary that occurs in ``documents``; the library's own lexicon does not.
ACUTE = ("pathetic", "disgusting")
SEVERE = ("worthless", "trash", "idiot", "stupid", "clown", "loser", "scum", "moron")
POSITIVE = ("with", "this", "from")
NEGATIVE = ACUTE + SEVERE

COEFFICIENTS = {
    "severe_density": 0.9,
    "first_person_density": 0.05,
    "negation_density": 0.1,
    "sentiment_score": -0.8,
    "log_n_words": 0.2,
}
INTERCEPT = -1.0
THRESHOLD = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int, rest: int = 0) -> Column:
    return F.col(column) % n == rest


# --- posts from documents ---------------------------------------------------------


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts with injected identifiers, blanks, bad dates and repeated rows."""
    docs = table(spark, sf_dir, "documents")
    doc_id, body = F.col("doc_id"), F.col("text")
    day = F.date_add(F.lit(FIRST_DAY), (doc_id * 7 % 480).cast("int"))
    injected = (
        F.when(_every("doc_id", 41), "[deleted]")
        .when(_every("doc_id", 43), "   ")
        .when(_every("doc_id", 47), F.lit(None).cast("string"))
        .when(_every("doc_id", 7, 1), F.concat(body, F.lit(" write to kim.w+"), doc_id, F.lit("@post.example.org today")))
        .when(_every("doc_id", 7, 2), F.concat(F.lit("look at HTTPS://pages.example.net/p/"), doc_id, F.lit(" and www.example.net/y too "), body))
        .when(_every("doc_id", 7, 3), F.concat(F.lit("as u/kim_"), doc_id, F.lit(" put it.\t\n "), body))
        .when(_every("doc_id", 7, 4), F.concat(body, F.lit(" credit to /u/Lee-Park.")))
        .when(_every("doc_id", 7, 5), F.concat(body, F.lit(" cc @lee"), doc_id, F.lit(" as well")))
        .when(_every("doc_id", 7, 6), F.concat(F.lit("my number is +44 (20) 7946-0018, "), body))
        .otherwise(body)
    )
    period = F.when(day < F.lit(dt.date(2020, 3, 11)), "pre").otherwise("post")
    copies = F.when(_every("doc_id", 10), F.array(period, F.lit("2019"))).otherwise(F.array(period))
    return docs.select(
        "doc_id",
        F.col("source").alias("subreddit"),
        F.when(_every("doc_id", 31), F.lit(None).cast("string"))
        .when(_every("doc_id", 37), "")
        .otherwise(F.concat(F.lit("user_"), doc_id % 97))
        .alias("author"),
        F.when(_every("doc_id", 53), "not-a-date")
        .when(_every("doc_id", 29), F.date_format(day, "y/M/d"))
        .otherwise(F.date_format(day, "yyyy/MM/dd"))
        .alias("created_date"),
        injected.alias("post"),
        F.explode(copies).alias("period"),
    ).withColumn("source_file", F.concat("subreddit", F.lit("_"), "period", F.lit(FILE_SUFFIX)))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_posts(spark, sf_dir)
        .withColumn("post_id", derive_post_id("subreddit", "author", "created_date", "post"))
        .withColumn("ingested_at", F.lit(LANDED_AT))
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.bronze_to_silver(bronze(spark, sf_dir), SALT)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a written layer, for queries that read it more than once."""
    return materialize(silver(spark, sf_dir), "silver")


def gold_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_posts(silver(spark, sf_dir))


def lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_with_lexicon(silver(spark, sf_dir), POSITIVE, NEGATIVE)


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows_of(silver(spark, sf_dir))


def training_rows_of(clean: DataFrame) -> DataFrame:
    """Features and label per post, all from one pass over the texts.

    In this order one projection has all searches for terms, so a text is lowered once.
    """
    numbers = signal.token_densities(clean, SEVERE, keep=("text",))
    labelled = numbers.withColumn("label", signal.weak_label("text", ACUTE, SEVERE))
    return scoring.with_lexicon_score(labelled, POSITIVE, NEGATIVE).select("post_id", *signal.FEATURES, "label")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(spark, sf_dir).drop("label")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.weak_labels(silver(spark, sf_dir), acute=ACUTE, severe=SEVERE)


# --- scored posts from orders -----------------------------------------------------


def scored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-post Gold rows: community = priority, author = customer."""
    salt = sv.secret_column(spark, SALT)
    orders = table(spark, sf_dir, "orders")
    scored = ~_every("o_orderkey", 11)
    sentiment = (F.col("o_totalprice") - 250000) / 250009
    day = F.col("o_orderdate").cast("date")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("post_id"),
        F.col("o_orderpriority").alias("subreddit"),
        day.alias("created_date"),
        F.date_sub(day, F.weekday(day)).alias("week"),
        hash_author(F.col("o_custkey").cast("string"), salt).alias("author_hash"),
        (F.col("o_orderkey") % 900 + 40).alias("n_chars"),
        (F.col("o_orderkey") % 180 + 8).alias("n_words"),
        F.when(scored, sentiment).alias("sentiment_score"),
        F.when(scored & (sentiment < -0.33), "negative")
        .when(scored & (sentiment > 0.33), "positive")
        .when(scored, "neutral")
        .alias("sentiment_label"),
        F.when(scored, F.col("o_totalprice") / 500009).alias("crisis_score"),
        F.when(scored, F.col("o_orderstatus") == "F").alias("crisis_flag"),
    )


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.weekly_rollup(scored_posts(spark, sf_dir))


# --- pages ------------------------------------------------------------------------


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page for each document: the address of a row of ``pages`` in turn, made unique by the document's number."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("base"))
    n_pages = pages.agg(F.count(F.lit(1))).scalar()
    docs = table(spark, sf_dir, "documents").withColumn("page_id", F.col("doc_id") % n_pages)
    address = F.concat(F.coalesce("base", F.lit("https://docs.example.org/en/")), F.lit("#d"), "doc_id")
    return docs.join(pages, "page_id", "left").select(F.col("doc_id").alias("position"), address.alias("url"), "text")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses(spark, sf_dir).select(
        "position",
        "url",
        F.when(~_every("position", 17), F.concat(F.lit("topic"), F.col("position") % 6)).alias("topic"),
    )


def allowed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allowlist: hosts of the pages below one domain."""
    pages = table(spark, sf_dir, "pages")
    return (
        pages.select(url_host("url").alias("host"))
        .where(F.col("host").endswith(".example.org"))
        .distinct()
    )


def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown per page: scaffolding around the whole text of its document."""
    intro = (
        "# Notes\n"
        "![logo](https://cdn.example.net/logo.png)\n"
        "- [Start](https://b.example.net/) [All notes](https://b.example.net/all/)\n"
        "\n\n\n"
        "More in the [full notes](https://b.example.net/full/) on this.\n\n"
    )
    markdown = F.concat(F.lit(intro), F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return addresses(spark, sf_dir).select(
        F.col("position").alias("page_id"),
        "url",
        F.when(_every("position", 13, 6), "").otherwise(markdown).alias("markdown"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached payloads; some were stored under an address the seeds no longer use."""
    page = F.col("page_id")
    stored = F.when(_every("page_id", 5, 3), F.concat("url", F.lit("#old"))).otherwise(F.col("url"))
    title = (
        F.when(
            _every("page_id", 3),
            F.to_json(F.array(F.concat(F.lit("Title "), page % 50), F.lit("Alternative"))),
        )
        .when(_every("page_id", 3, 1), F.concat(F.lit('"Title '), page % 50, F.lit('"')))
    )
    metadata = F.struct(
        F.parse_json(title).alias("title"),
        F.when(~_every("page_id", 4), F.col("url")).alias("sourceURL"),
        F.when(_every("page_id", 8), F.concat("url", F.lit("?via=cache"))).alias("url"),
    )
    return page_markdown(spark, sf_dir).select(
        corpus.cache_key(stored).alias("key"),
        (page % 11 != 5).alias("success"),
        F.struct("markdown", metadata.alias("metadata")).alias("data"),
    )


def all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a document, refused by nothing, the first of those with the same content."""
    pages = page_markdown(spark, sf_dir).join(seeds(spark, sf_dir).drop("url"), F.col("page_id") == F.col("position"))
    metadata = F.struct(F.lit(None).cast("variant").alias("title"), F.lit(None).cast("string").alias("sourceURL"), F.lit(None).cast("string").alias("url"))
    rows = pages.select("position", "url", F.coalesce("topic", F.lit(corpus.DEFAULT_TOPIC)).alias("topic"), F.struct("markdown", metadata.alias("metadata")).alias("data"))
    built = corpus.to_documents(rows, F.lit(RETRIEVED_AT))
    return corpus.documents(built.withColumn("reason", F.lit(None).cast("string")))


def crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.crawl(
        seeds(spark, sf_dir),
        payloads(spark, sf_dir),
        allowed_hosts(spark, sf_dir),
        F.lit(RETRIEVED_AT),
    )


# --- retrieval and questions --------------------------------------------------------


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("topic")
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of a conversation as a question, with asks about trends and people mixed in."""
    conv = F.col("conv_id") + F.col("turn")
    text = (
        F.when(conv % 5 == 1, F.concat(F.lit("Who wrote this? "), F.col("text")))
        .when(conv % 5 == 2, F.lit("how did the mood of the communities change in spring?"))
        .when(conv % 5 == 3, F.lit("  "))
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", text.alias("question"))
