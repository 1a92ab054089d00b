"""Cached page payloads as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodtide.schemas import PAYLOADS


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload rows (key, success, data); titles may be text or a list."""
    return spark.read.schema(PAYLOADS).json(path)
