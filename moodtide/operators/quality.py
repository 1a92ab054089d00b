"""Data-quality checks as small result frames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: (column, failures)."""
    columns = list(columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "failures")


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return (
        df.dropna(subset=list(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list, with their number."""
    known = F.col(column).isin(list(accepted))
    return (
        df.where(F.col(column).isNotNull() & ~known)
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def out_of_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows outside [low, high] per column; unknown values pass."""
    checks = [
        F.count_if(~F.col(c).between(low, high)).alias(c) for c, (low, high) in bounds.items()
    ]
    return df.agg(*checks).unpivot([], list(bounds), "column", "failures")


def reconcile(left: DataFrame, right: DataFrame, column: str, day: str) -> DataFrame:
    """Groups whose row count or date span differs between two copies of a table."""

    def profile(df: DataFrame, suffix: str) -> DataFrame:
        return df.groupBy(F.col(column).alias(f"{column}_{suffix}")).agg(
            F.count(F.lit(1)).alias(f"rows_{suffix}"),
            F.min(day).alias(f"first_{suffix}"),
            F.max(day).alias(f"last_{suffix}"),
        )

    same_key = F.col(f"{column}_left").eqNullSafe(F.col(f"{column}_right"))
    joined = profile(left, "left").join(profile(right, "right"), same_key, "full_outer")
    equal = reduce(
        lambda a, b: a & b,
        [F.col(f"{m}_left").eqNullSafe(F.col(f"{m}_right")) for m in ("rows", "first", "last")],
    )
    return joined.withColumn("matches", equal).select(
        F.coalesce(f"{column}_left", f"{column}_right").alias(column),
        "rows_left",
        "rows_right",
        "first_left",
        "first_right",
        "last_left",
        "last_right",
        "matches",
    )


@dataclass
class Rules:
    """What every row of a table has to keep; each rule counts the rows that break it."""

    not_null: Sequence[str] = ()
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def counts(self) -> dict[tuple[str, str], Column]:
        """(column, test): the count of failures, as ``null_counts``, ``out_of_bounds`` and ``unexpected_values`` have it."""
        out = {(c, "not_null"): F.count_if(F.col(c).isNull()) for c in self.not_null}
        out |= {(c, "bounds"): F.count_if(~F.col(c).between(*ends)) for c, ends in self.bounds.items()}
        known = {c: F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in self.accepted.items()}
        return out | {(c, "accepted"): F.count_if(odd) for c, odd in known.items()}


def write_checked(df: DataFrame, rules: Rules, write: Callable[[DataFrame], None]) -> DataFrame:
    """Writes ``df`` by ``write`` and counts, in the same job, the rows that break each rule: (column, test, failures).

    The counts are observed metrics of the rows on their way to the files, so no row
    is computed or read a second time. ``rows`` counts all. The caller publishes what
    was written, or discards it, by the verdict (``require``).
    """
    spark, counts = df.sparkSession, rules.counts()
    watch = Observation()
    named = [c.alias(f"{k}") for k, c in enumerate(counts.values())]
    write(df.observe(watch, F.count(F.lit(1)).alias("rows"), *named))
    found = watch.get
    rows = [("*", "rows", found["rows"]), *[(c, test, found[str(k)]) for k, (c, test) in enumerate(counts)]]
    return spark.createDataFrame(rows, "`column` string, test string, failures bigint")


def require(verdict: DataFrame) -> None:
    """Raises, naming every rule that failed, unless no row breaks one."""
    failed = verdict.where("test <> 'rows' AND failures > 0").orderBy("column", "test").collect()  # a row for each rule
    if failed:
        raise AssertionError("checks failed: " + ", ".join(f"{r['column']} {r['test']} ({r['failures']} rows)" for r in failed))
