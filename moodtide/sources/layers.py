"""Layer tables: partitioned Bronze, versioned Silver and Gold, exports."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from moodtide.operators import quality
from moodtide.schemas import BRONZE, GOLD_WEEKLY, conform

POINTER = "_CURRENT"
# The names of the Gold tables.
POSTS_TABLE, WEEKLY_TABLE = "gold_posts_features", "gold_subreddit_weekly"
LIVE, FALLBACK = "live", "fallback"


# --- file system ----------------------------------------------------------------


def _hadoop_path(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    system, handle = _hadoop_path(spark, path)
    return system.exists(handle)


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Any parquet file below the path? The listing stops at the first."""
    system, handle = _hadoop_path(spark, path)
    if not system.exists(handle):
        return False
    files = system.listFiles(handle, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


# --- Bronze ---------------------------------------------------------------------


def write_bronze(bronze: DataFrame, path: str) -> DataFrame:
    """Land Bronze by (subreddit, period), replacing only the partitions present.

    The rebalance hint lets AQE split a community that holds a third of all rows
    over many files and merge the tiny ones, instead of one file per task.
    Returns the row count per source file.
    """
    spread = bronze.hint("rebalance", "subreddit", "period")
    (
        spread.write.partitionBy("subreddit", "period")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    return landed_counts(read_bronze(bronze.sparkSession, path))


def landed_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))


def read_bronze(spark: SparkSession, *paths: str) -> DataFrame:
    """All landed files as one table; an empty landing zone is an error."""
    if not any(has_parquet(spark, p) for p in paths):
        raise FileNotFoundError(f"no Bronze parquet under {paths}: land the corpus first")
    return spark.read.schema(BRONZE).parquet(*paths).select(*conform(BRONZE))


# --- versioned layers -----------------------------------------------------------


def publish(df: DataFrame, root: str) -> str:
    """Write a new version of a table, then point readers to it.

    The plan may read the current version: nothing is overwritten, and a failed
    job leaves the pointer where it was.
    """
    version, _ = stage(df, root)
    point_to(df.sparkSession, root, version)
    return version


def next_version(spark: SparkSession, root: str) -> str:
    """``v<number>-<random>``: two writers at the same time never share a folder."""
    current = current_version(spark, root)
    number = int(current[1:].split("-")[0]) + 1 if current else 1
    return f"v{number:06d}-{uuid.uuid4().hex[:8]}"


def stage(df: DataFrame, root: str) -> tuple[str, DataFrame]:
    """Write the next version without publishing it; returns its name and rows."""
    spark = df.sparkSession
    target = next_version(spark, root)
    df.write.parquet(f"{root}/{target}")
    return target, spark.read.schema(df.schema).parquet(f"{root}/{target}")


def discard(spark: SparkSession, root: str, version: str) -> None:
    """Remove a version that was never published."""
    system, handle = _hadoop_path(spark, f"{root}/{version}")
    system.delete(handle, True)


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Publish a staged version: a new pointer takes the old one's place in one rename."""
    system, fresh = _hadoop_path(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    out = system.create(fresh, False)
    out.write(bytearray(version.encode()))
    out.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    files.rename(fresh, _hadoop_path(spark, f"{root}/{POINTER}")[1], options)


def current_version(spark: SparkSession, root: str) -> str | None:
    if not exists(spark, f"{root}/{POINTER}"):
        return None
    system, handle = _hadoop_path(spark, f"{root}/{POINTER}")
    stream = system.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_layer(spark: SparkSession, root: str, schema: StructType, part: str = "") -> DataFrame:
    """The published version, or one of the tables that it holds."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.schema(schema).parquet(f"{root}/{version}{part and '/' + part}")


def publish_checked(df: DataFrame, root: str, rules: quality.Rules) -> DataFrame:
    """``publish`` with the rules checked while the rows are written; what breaks one is not published but removed."""
    spark = df.sparkSession
    version = next_version(spark, root)
    try:
        verdict = quality.write_checked(df, rules, lambda rows: rows.write.parquet(f"{root}/{version}"))
        quality.require(verdict)
    except BaseException:
        discard(spark, root, version)
        raise
    point_to(spark, root, version)
    return verdict


def save_bucketed(df: DataFrame, table: str, key: str = "post_id", buckets: int = 200, path: str | None = None) -> None:
    """Catalog table bucketed and sorted by its key, in the warehouse or below ``path``.

    Score merges, anti-joins and feature joins on the key then need no shuffle.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


# --- warehouse ------------------------------------------------------------------


def load_table(
    df: DataFrame, schema: StructType, required: Sequence[str], path: str
) -> DataFrame:
    """Idempotent reload: cast on copy, NULLs in required columns fail the write."""
    columns = []
    for f in schema.fields:
        value = F.col(f.name).cast(f.dataType)
        if f.name in required:
            stop = F.raise_error(F.lit(f"NULL in required column {f.name}")).cast(f.dataType)
            value = F.when(value.isNull(), stop).otherwise(value)
        columns.append(value.alias(f.name))
    df.select(*columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def verify_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows on both sides of a copy."""
    loaded = target.agg(F.count(F.lit(1))).scalar()
    counts = source.agg(F.count(F.lit(1)).alias("source_rows"))
    return counts.withColumn("target_rows", loaded).withColumn(
        "matches", F.col("source_rows") == F.col("target_rows")
    )


# --- exports and fallback -------------------------------------------------------


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def weekly_source(spark: SparkSession, gold: str, fallback: DataFrame) -> tuple[str, DataFrame]:
    """The weekly table once a version of it is published, else the fallback."""
    table = f"{gold}/{WEEKLY_TABLE}"
    if current_version(spark, table) is None:
        return FALLBACK, fallback
    return LIVE, read_layer(spark, table, GOLD_WEEKLY)


def replace_if_any(df: DataFrame, root: str) -> bool:
    """Publish a rebuilt table unless it is empty; an empty build changes nothing.

    The rows are staged first, so the build runs once and the test is a look at
    the staged files.
    """
    version, staged = stage(df, root)
    if staged.isEmpty():
        discard(df.sparkSession, root, version)
        return False
    point_to(df.sparkSession, root, version)
    return True
