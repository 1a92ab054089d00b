"""Quoted CSV files read by many tasks each.

A line break inside quotes does not end a record, so a task that starts in the
middle of a file cannot tell where its first record begins. Here the files are
read as plain lines, which Spark splits by byte ranges, and quotes are counted
first: each range says what it does to the state, open or not, that it is entered
with; a running composition over the ranges of a file gives every range its
opening state; then all ranges cut their lines into records side by side. A record
that crosses ranges is put together from its pieces.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from moodtide.session import scratch_dir
from moodtide.sources.landing import RAW_COLUMNS, file_path, to_bronze

QUOTE, COMMA = 0x22, 0x2C
BOM = "﻿"
LAYOUTS = 1_000  # different header lines of one run
RANGES_AT_ONCE = 100_000  # opening states that travel with the tasks; beyond it they are joined by shuffle

RANGE = "path string, start bigint, resets boolean, flips boolean, header string"
PIECE = "path string, start bigint, layout int, begins boolean, piece string, record string"
HEADER = -1  # the layout of pieces of a header that goes over several ranges


@dataclass
class Quotes:
    """What each line of a batch does to the open state, as arrays: known after it, and open after it if closed before."""

    resets: np.ndarray
    flips: np.ndarray


def quotes(lines: pa.Array) -> Quotes:
    """The effect of each line: ``resets`` where the state after it is known, whatever it was before, and
    ``flips``, the state after a reset or else whether the line turns the state round.

    Quotes come in runs. A run of even length changes nothing: pairs inside quotes,
    or an empty field. One of odd length opens a field if it stands at its start and
    closes one otherwise; a quote in the middle of an unquoted field is plain text.
    So a run after a comma or a line's start turns the state round, any other leaves
    it closed.
    """
    n = len(lines)
    resets, flips = np.zeros(n, bool), np.zeros(n, bool)
    if not n:
        return Quotes(resets, flips)
    lines = lines.cast(pa.large_string()).fill_null("")
    _, offsets, data = lines.buffers()
    ends = np.frombuffer(offsets, "<i8", n + 1, lines.offset * 8)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    at = np.flatnonzero(raw == QUOTE)
    if not len(at):
        return Quotes(resets, flips)
    line = np.searchsorted(ends, at, side="right") - 1
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (line[1:] != line[:-1])
    begin = np.flatnonzero(first)
    odd = np.diff(np.append(begin, len(at))) % 2 == 1
    at, line = at[begin][odd], line[begin][odd]
    opens = (at == ends[line]) | (raw[np.maximum(at - 1, 0)] == COMMA)
    turns = np.cumsum(opens)
    last = np.maximum.accumulate(np.where(opens, -1, np.arange(len(at))))  # the last run that closes, up to each
    own = np.searchsorted(line, np.arange(n + 1))
    some = np.flatnonzero(own[1:] > own[:-1])
    end, start = own[1:][some] - 1, own[:-1][some]
    resets[some] = last[end] >= start
    base = np.where(resets[some], turns[last[end]], turns[start] - opens[start])
    flips[some] = (turns[end] - base) % 2 == 1
    return Quotes(resets, flips)


def states(effect: Quotes, opened: bool) -> np.ndarray:
    """The state before each line and, as one more, after the last."""
    n = len(effect.flips)
    turned = np.cumsum(effect.flips)
    last = np.maximum.accumulate(np.where(effect.resets, np.arange(n), -1)) if n else np.zeros(0, int)
    base = np.where(last >= 0, turned[last] - effect.flips[last], 0) if n else np.zeros(0, int)
    after = (turned - base + np.where(last >= 0, 0, opened)) % 2 == 1
    return np.concatenate([[opened], after])


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).text(list(paths), lineSep="\n")
    return text.select("value", file_path().alias("path"), F.col("_metadata.file_block_start").alias("start"))


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch, bool]]:
    """Slices that lie in one range each, in order, and whether one begins its range. A task reads range after range."""
    before = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        starts, paths = batch.column("start").to_numpy(), batch.column("path")
        new = np.ones(n, bool)
        new[1:] = starts[1:] != starts[:-1]
        if n > 1:
            codes = paths.dictionary_encode().indices.to_numpy()
            new[1:] |= codes[1:] != codes[:-1]
        cuts = [*np.flatnonzero(new), n]
        for a, b in zip(cuts, cuts[1:]):
            key = (paths[a].as_py(), int(starts[a]))
            yield key, batch.slice(a, b - a), key != before
            before = key


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each range: what it does to the state, and of a file's first range the header as it stands."""
    rows: list[dict] = []
    heading: list[str] | None = None  # lines of a header that has not ended
    for (path, start), lines, new in _by_range(batches):
        if new:
            rows.append({"path": path, "start": start, "resets": False, "flips": False, "header": None})
            heading = [] if start == 0 else None
        effect, row = quotes(lines.column("value")), rows[-1]
        if heading is not None:
            open_after = states(effect, bool(heading))[1:]
            stop = len(open_after) if open_after.all() else int(open_after.argmin()) + 1
            heading += lines.column("value").slice(0, stop).to_pylist()
            row["header"] = "\n".join(heading)
            heading = heading if open_after.all() else None
        resets, after = bool(effect.resets.any()), bool(states(effect, False)[-1])
        row["flips"] = after if resets else row["flips"] ^ after
        row["resets"] |= resets
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    names = ["path", "start", "resets", "flips", "header"]
    yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(names, kinds))))


def ranges(spark: SparkSession, *paths: str) -> DataFrame:
    """path, start, opened (the state a range is entered with) and header of each byte range of the files."""
    found = scratch_dir(spark, "csv-ranges")
    _lines(spark, paths).mapInArrow(_effects, RANGE).write.parquet(found)
    each = spark.read.schema(RANGE).parquet(found)
    order = Window.partitionBy("path").orderBy("start")
    turned = F.sum(F.col("flips").cast("int")).over(order)
    after_reset = F.when(F.col("resets"), F.col("turned") - F.col("flips").cast("int"))
    placed = each.withColumn("turned", turned).withColumn("base", F.last(after_reset, ignorenulls=True).over(order))
    after = (F.col("turned") - F.coalesce("base", F.lit(0))) % 2 == 1
    return placed.withColumn("after", after).select(
        "path",
        "start",
        F.coalesce(F.lag("after").over(order), F.lit(False)).alias("opened"),
        F.first("header").over(order).alias("header"),
    )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records as ``record``; what belongs to a record of an earlier range, and the beginning of one that
    goes on in the next, as ``piece``. A file's first record, the header, is left out.

    Lines that are a record each are taken as they are; only those of longer records are looked at singly.
    """
    held: list[str] = []
    opened = heading = begun = False  # heading: the header is still to come; begun: the record at hand began in this range
    at, layout = ("", 0), 0
    rest: list[tuple] = []

    def put(record: bool) -> None:
        text = "\n".join(held)
        held.clear()
        own = HEADER if heading else layout
        if not (record and begun):
            rest.append((*at, own, begun, text, None))
        elif not heading:
            rest.append((*at, own, True, None, text))

    def flushed(lines: pa.Array) -> pa.RecordBatch:
        n = len(lines)
        path, start, own, begins, piece, record = zip(*rest) if rest else [()] * 6
        rest.clear()
        columns = [
            pa.array([*path, *[at[0]] * n], pa.string()),
            pa.array([*start, *[at[1]] * n], pa.int64()),
            pa.array([*own, *[layout] * n], pa.int32()),
            pa.array([*begins, *[True] * n], pa.bool_()),
            pa.array([*piece, *[None] * n], pa.string()),
            pa.concat_arrays([pa.array(record, pa.string()), lines.cast(pa.string())]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["path", "start", "layout", "begins", "piece", "record"])

    empty = pa.array([], pa.string())
    for key, lines, new in _by_range(batches):
        if new:
            if held:
                put(record=False)
                yield flushed(empty)
            at, layout = key, lines.column("layout")[0].as_py()
            opened = bool(lines.column("opened")[0].as_py())
            heading, begun = at[1] == 0, not opened
        value = lines.column("value")
        state = states(quotes(value), opened)
        opened = bool(state[-1])
        alone = ~state[:-1] & ~state[1:]
        longer = np.flatnonzero(~alone)
        if heading and alone[0]:
            alone[0] = heading = False
        for line, inside, goes_on in zip(value.take(pa.array(longer)).to_pylist(), state[:-1][longer], state[1:][longer]):
            begun |= not inside
            held.append(line)
            if not goes_on:
                put(record=True)
                heading = False
        yield flushed(value.filter(pa.array(alone)))
    if held:
        put(record=False)
        yield flushed(empty)


def _joined(pieces: DataFrame) -> DataFrame:
    """Records put together from the pieces of neighbouring ranges, of which the first begins one."""
    order = Window.partitionBy("path").orderBy("start", "begins")
    numbered = pieces.withColumn("record_no", F.sum(F.col("begins").cast("int")).over(order))
    lines = F.array_sort(F.collect_list(F.struct("start", "begins", "piece")))
    record = F.array_join(F.transform(lines, lambda x: x["piece"]), "\n")
    return numbered.groupBy("path", "record_no").agg(F.min("layout").alias("layout"), record.alias("record")).where(F.col("layout") != HEADER)


def _parsed(record: Column, headers: Sequence[str]) -> Column:
    """The raw columns of a record, by the header of its layout."""

    def fields(header: str) -> Column:
        names = next(csv.reader([header.removeprefix(BOM).removesuffix("\r")], strict=True))
        missing = [c for c in RAW_COLUMNS if c not in names]
        if missing:
            raise ValueError(f"corpus file without column {missing}: {header[:200]!r}")
        text = F.regexp_replace(record, "\r\\z", "") if header.endswith("\r") else record
        row = F.from_csv(text, ", ".join(f"c{i} string" for i in range(len(names))), {"escape": '"', "multiLine": "true"})
        return F.struct(*[row[f"c{names.index(c)}"].alias(c) for c in RAW_COLUMNS])

    chosen = fields(headers[0])
    for k, header in enumerate(headers[1:], 1):
        chosen = F.when(F.col("layout") == k, fields(header)).otherwise(chosen)
    return chosen


def land(spark: SparkSession, *paths: str, ingested_at: Column | None = None) -> DataFrame:
    """Corpus CSV files as Bronze rows, as ``land_csv`` gives them, but with many tasks for a large file.

    Two passes over the lines: one counts quotes, one cuts records, which are parsed
    in the JVM and written with the raw columns only. Every file is read by its own
    header, so files may differ in the order of their columns. Records that cross
    the borders of ranges are put together afterwards from at most two pieces a range.

    Records end with a line feed, with a carriage return before it if the header
    has one; quotes inside quotes are doubled; blank lines are no records. Empty
    files give no rows, and a file that ends inside quotes ends its last record
    there. A header without one of the raw columns is an error.
    """
    found = ranges(spark, *paths)
    headers = [r[0] for r in found.where("start = 0").select("header").distinct().orderBy("header").limit(LAYOUTS + 1).collect()]
    if len(headers) > LAYOUTS:
        raise ValueError(f"over {LAYOUTS} different header lines; land the files in smaller runs")
    target = scratch_dir(spark, "csv-records")
    raw = f"{', '.join(f'{c} string' for c in RAW_COLUMNS)}, path string"
    if not headers:
        return to_bronze(spark.createDataFrame([], raw), F.col("path"), ingested_at)
    layout = F.array_position(F.array(*[F.lit(h) for h in headers]), F.col("header")).cast("int") - 1
    opened = found.select("path", "start", "opened", layout.alias("layout"))
    lines = _lines(spark, paths)
    if found.count() <= RANGES_AT_ONCE:
        ready = lines.join(F.broadcast(opened), ["path", "start"])  # keeps the order of lines
    else:
        numbered = lines.withColumn("at", F.monotonically_increasing_id())
        ready = numbered.join(opened, ["path", "start"]).sortWithinPartitions("path", "start", "at")
    cut = ready.select("value", "path", "start", "opened", "layout").mapInArrow(_records, PIECE)
    blank = F.col("record").rlike(r"^\r?\z")
    kept = cut.where(F.col("record").isNull() | ~blank)
    kept.select("path", "start", "layout", "begins", "piece", _parsed(F.col("record"), headers).alias("row")).write.parquet(target)
    done = spark.read.parquet(target)
    whole = done.where("piece is null").select("path", "row.*")
    joined = _joined(done.where("piece is not null").drop("row")).where(~blank)
    crossing = joined.select("path", _parsed(F.col("record"), headers).alias("row")).select("path", "row.*")
    return to_bronze(whole.union(crossing), F.col("path"), ingested_at)
