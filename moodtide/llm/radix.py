"""Ranks of all rows of a table by a distributed least-significant-digit radix sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from moodtide.llm.frames import materialize

DIGIT_BITS = 11
BLOCK_BITS = 13  # rows of one block; no task meets more of one digit at a time
SIGN = -(1 << 63)


def ranked(rows: DataFrame, keys: Sequence[Column], name: str = "rank", digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3 ... in ascending order of ``keys``, longs without nulls, the first the most significant.

    From the last digit of the last key to the first digit of the first, a stable
    counting sort moves every row to its next position: rows are counted by block
    of positions and digit, running sums of the counts are the global offsets, and
    a row's place among those of its block and digit comes on top. Leading digits
    that all rows share are left out. A pass shuffles each row once, by block and
    digit, so a digit that many rows share is split by the blocks. Every pass is
    written to the shared folder. Equal keys get ranks in any order.
    """
    width = len(keys)
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns]) if rows.columns else F.lit(None)
    work = rows.select(own.alias("row"), *[k.cast("long").alias(f"k{i}") for i, k in enumerate(keys)])
    work = materialize(work.withColumn("at", F.monotonically_increasing_id()), "radix")
    ends = work.agg(*[f(f"k{i}").alias(f"{n}{i}") for i in range(width) for n, f in (("min", F.min), ("max", F.max))]).first()
    digits = []
    for i in reversed(range(width)):
        if ends[f"min{i}"] is None:
            continue
        spread = (ends[f"min{i}"] ^ ends[f"max{i}"]) % (1 << 64)
        unsigned = F.col(f"k{i}").bitwiseXOR(F.lit(SIGN))
        mask = (1 << digit_bits) - 1
        digits += [F.shiftrightunsigned(unsigned, s).bitwiseAND(F.lit(mask)) for s in range(0, spread.bit_length(), digit_bits)]
    for digit in digits or [F.lit(0)]:
        work = materialize(_sorted_by(work, digit, block_bits), "radix")
    return work.select("row.*", (F.col("at") + 1).alias(name)) if rows.columns else work.select((F.col("at") + 1).alias(name))


def _sorted_by(work: DataFrame, digit: Column, block_bits: int) -> DataFrame:
    """One stable counting-sort pass: ``at`` becomes the row's destination."""
    marked = work.withColumns({"digit": digit.cast("int"), "block": F.shiftright("at", block_bits)})
    counts = marked.groupBy("digit", "block").agg(F.count("*").alias("n"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))  # one row for each value of a digit
    below = F.sum("n").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("digit", F.coalesce(below, F.lit(0)).alias("base"))
    earlier = F.sum("n").over(Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("digit", "block", F.coalesce(earlier, F.lit(0)).alias("earlier")).join(bases, "digit")
    place = F.row_number().over(Window.partitionBy("digit", "block").orderBy("at"))
    moved = marked.withColumn("place", place).join(offsets, ["digit", "block"])
    return moved.select(*[c for c in work.columns if c != "at"], (F.col("base") + F.col("earlier") + F.col("place") - 1).alias("at"))
