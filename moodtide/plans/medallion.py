"""Bronze to Gold, and the score refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from moodtide.operators import gold, silver as sv
from moodtide.schemas import GOLD_POSTS, GOLD_WEEKLY, SILVER, conform
from moodtide.sources import layers


def silver_path(root: str) -> str:
    return f"{root}/silver/posts"


def posts_path(root: str) -> str:
    return f"{root}/gold/{layers.POSTS_TABLE}"


def weekly_path(root: str) -> str:
    return f"{root}/gold/{layers.WEEKLY_TABLE}"


def run(bronze: DataFrame, root: str, salt: str) -> DataFrame:
    """Publish Silver, per-post Gold and weekly Gold; returns the run report.

    A post in which a pattern is still found after the scrub (one may arise where
    another was cut out) goes to quarantine: without its text, so that nothing raw
    is written, and counted in the report. One odd post thus stops no run.

    Silver is staged and verified there: the checks read the written rows once
    instead of recomputing the scrub. If they fail, the staged rows are removed
    before the error goes on, and nothing is published.
    """
    spark, path = bronze.sparkSession, silver_path(root)
    version = layers.next_version(spark, path)
    marked = sv.quarantined(sv.bronze_to_silver(bronze, salt))
    try:
        marked.write.partitionBy("quarantine").parquet(f"{path}/{version}")
        both = spark.read.schema(marked.schema).parquet(f"{path}/{version}")
        staged = both.where("NOT quarantine").select(*conform(SILVER))
        sv.assert_anonymized(staged, sv.distinct_authors(bronze))
    except BaseException:
        layers.discard(spark, path, version)
        raise
    layers.point_to(spark, path, version)
    layers.publish(gold.gold_posts(staged), posts_path(root))
    publish_weekly(spark, root)
    odd = both.where("quarantine").agg(F.count(F.lit(1))).scalar()
    return sv.run_report(bronze, staged).withColumn("quarantined", odd)


def publish_weekly(spark: SparkSession, root: str) -> None:
    posts = layers.read_layer(spark, posts_path(root), GOLD_POSTS)
    layers.publish(gold.ordered_weekly(gold.weekly_rollup(posts)), weekly_path(root))


def refresh_scores(
    spark: SparkSession, root: str, scores: DataFrame, columns: tuple[str, ...]
) -> None:
    """Merge scores into the per-post table as a new version, then roll up again."""
    posts = layers.read_layer(spark, posts_path(root), GOLD_POSTS)
    layers.publish(gold.apply_scores(posts, scores, columns), posts_path(root))
    publish_weekly(spark, root)


def _silver_and_quarantine(spark: SparkSession, root: str) -> DataFrame:
    with_mark = StructType([*SILVER.fields, StructField("quarantine", BooleanType())])
    return layers.read_layer(spark, silver_path(root), with_mark)


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return _silver_and_quarantine(spark, root).where("NOT quarantine").select(*conform(SILVER))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Posts kept out of Silver, without their texts."""
    return _silver_and_quarantine(spark, root).where("quarantine").drop("quarantine", "text")


def read_posts(spark: SparkSession, root: str) -> DataFrame:
    return layers.read_layer(spark, posts_path(root), GOLD_POSTS)


def read_weekly(spark: SparkSession, root: str) -> DataFrame:
    return layers.read_layer(spark, weekly_path(root), GOLD_WEEKLY)
