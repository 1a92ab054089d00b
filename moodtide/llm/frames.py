"""Small Spark helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from moodtide.session import materialize, scratch_dir

__all__ = ["columns", "map_batches", "materialize", "plus", "read_table", "row_of", "scratch_dir", "text_buffers", "whole_keys"]

# Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(names: Iterable[str]) -> list[Column]:
    """Top-level columns by their names, whatever characters these hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def row_of(df: DataFrame) -> Column:
    """All columns as one struct, so that none can clash with a helper column; ``.select("<alias>.*")`` gives them back."""
    return F.struct(*columns(df.columns))


def plus(df: DataFrame, names: Iterable[str], more: str) -> StructType:
    """The fields ``names`` of ``df`` and those of the schema string ``more``."""
    return StructType([*(df.schema[n] for n in names), *StructType.fromDDL(more).fields])


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str | StructType, text: str | None = None
) -> DataFrame:
    """``fn`` over Arrow batches, cut so that column ``text`` has about STEP_BYTES in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, text) if text else [batch]:
                out = fn(part)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    if all(name.isidentifier() for name in df.columns):
        return df.mapInArrow(run, schema)
    # Spark looks its input columns up by name, as if a dot or a backtick in one were syntax.
    names, fields = df.columns, schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    wanted, plain = fields.names, [f"c{i}" for i in range(len(fields))]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(pa.RecordBatch.from_arrays(b.columns, names) for b in batches):
            yield pa.RecordBatch.from_arrays([out.column(out.schema.names.index(n)) for n in wanted], plain)

    safe = StructType([StructField(p, f.dataType, f.nullable) for p, f in zip(plain, fields)])
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, safe).toDF(*wanted)


def cut(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most STEP_BYTES of ``text``, or one row."""
    if not batch.num_rows:
        return
    ends = text_buffers(batch.column(text))[1][1:]
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + STEP_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and n + 1 offsets that begin at 0; a null counts as empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, "<i8", len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows from batches sorted by ``key``; a key is never split."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
        if last:
            yield table.slice(0, last)
        held = table.slice(last).to_batches()
        size = table.num_rows - last
    if held:
        yield pa.Table.from_batches(held)
