"""Checkpointed landing.

An ``availableNow`` file stream: a run handles the files that arrived since the
last one and stops. Progress is kept in the checkpoint folder, so a killed run
goes on where it was. Scoring resumes in batch (``plans.scoring``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from moodtide.sources.landing import csv_reader, file_path, to_bronze


def land_new_files(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, raw_schema: StructType
) -> StreamingQuery:
    """Append corpus files not landed before; ``raw_schema`` is their header, in order."""
    raw = csv_reader(spark.readStream).schema(raw_schema).csv(landing)
    rows = to_bronze(raw, file_path())
    return (
        rows.writeStream.format("parquet")
        .partitionBy("subreddit", "period")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze)
    )
