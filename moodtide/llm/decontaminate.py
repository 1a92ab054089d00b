"""Benchmark decontamination: pigeonhole pieces and Myers' bit-parallel distance over words."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from moodtide.llm import words as W
from moodtide.llm.frames import map_batches, materialize, plus, row_of, text_buffers

ERROR_RATE = 0.2  # edits, as a share of an item's words, up to which a passage is the item
ITEMS_AT_ONCE = 5_000  # items that travel to the tasks together; more items take more passes
FLAG_BITS = 20
ARROW = {"bigint": pa.int64(), "int": pa.int32()}


def _separators() -> np.ndarray:
    """Words are runs of ASCII letters and digits and of all bytes beyond ASCII."""
    flags = np.ones(256, bool)
    flags[0x80:] = False
    flags[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = False
    return flags


SEPARATORS = _separators()


def plain_words(texts: pa.Array) -> W.Words:
    """Words of lower-cased texts; punctuation does not count."""
    return W.find(*text_buffers(pc.utf8_lower(texts)), SEPARATORS)


def myers(pattern: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any stretch of ``text``, and where the first such stretch ends.

    Bit k of the two vectors says whether the distance rises or falls from
    pattern place k to k + 1, so a step is a few operations on one integer.
    """
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    places: dict[bytes, int] = {}
    for k, symbol in enumerate(pattern):
        places[symbol] = places.get(symbol, 0) | 1 << k
    up, down, score = full, 0, size
    best, end = size, 0
    for at, symbol in enumerate(text, 1):
        equal = places.get(symbol, 0)
        either = equal | down
        carried = (((equal & up) + up) ^ up) | equal
        rise = down | (full & ~(carried | up))
        fall = up & carried
        score += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(either | rise)), rise & either
        if score < best:
            best, end = score, at
    return best, end


@dataclass
class Items:
    """Test items cut into pieces: of budget + 1 pieces, at least one is intact in any passage within the budget."""

    ids: list
    words: list[list[bytes]]
    budgets: list[int]
    times: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    flags: dict[int, np.ndarray] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    owners: dict[int, np.ndarray] = field(default_factory=dict)
    offsets: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list[tuple[object, str, int]], rate: float) -> Items:
        found = plain_words(pa.array([t for _, t, _ in rows], pa.string()))
        text, hashes = found.raw.tobytes(), found.hashes()
        items, pieces = cls([], [], []), {}
        for k, (item, _, times) in enumerate(rows):
            a, b = int(found.first[k]), int(found.first[k + 1])
            if a == b:
                continue
            budget = math.floor(rate * (b - a))
            cuts = [a + (b - a) * j // (budget + 1) for j in range(budget + 2)]
            for low, high in zip(cuts, cuts[1:]):
                pieces.setdefault(high - low, []).append((W.gram_hashes(hashes[low:high], high - low)[0], len(items.ids), low - a))
            items.ids.append(item)
            items.times.append(times)
            items.words.append([text[x:y] for x, y in zip(found.starts[a:b].tolist(), found.ends[a:b].tolist())])
            items.budgets.append(budget)
        for size, own in sorted(pieces.items()):
            own.sort()
            items.lengths.append(size)
            items.hashes[size] = np.array([x[0] for x in own], np.uint64)
            items.owners[size] = np.array([x[1] for x in own])
            items.offsets[size] = np.array([x[2] for x in own])
            items.flags[size] = np.zeros(1 << FLAG_BITS, bool)
            items.flags[size][items.hashes[size] >> np.uint64(64 - FLAG_BITS)] = True
        return items

    def hits(self, w: W.Words) -> np.ndarray:
        """(row, item, first word at which the item would begin) of every piece found in the rows."""
        hashes, out = w.hashes(), [np.zeros((0, 3), np.int64)]
        for size in self.lengths:
            grams = W.gram_hashes(hashes, size)
            at = np.flatnonzero(self.flags[size][grams >> np.uint64(64 - FLAG_BITS)])
            at = at[w.doc[at] == w.doc[at + size - 1]]
            low = np.searchsorted(self.hashes[size], grams[at], "left")
            n = np.searchsorted(self.hashes[size], grams[at], "right") - low
            piece = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            place = np.repeat(at, n)
            out.append(np.stack([w.doc[place], self.owners[size][piece], place - self.offsets[size][piece]], 1))
        return np.unique(np.concatenate(out), axis=0)

    def matches(self, w: W.Words) -> list[tuple[int, int, int, int]]:
        """(row, item, distance, last word) for each item within its budget in a row."""
        text, out = w.raw.tobytes(), []
        hits = self.hits(w)
        cut = np.flatnonzero(np.any(hits[1:, :2] != hits[:-1, :2], axis=1)) + 1
        for own in np.split(hits, cut) if len(hits) else []:
            row, item = own[0, :2].tolist()
            pattern, budget = self.words[item], self.budgets[item]
            first, last = int(w.first[row]), int(w.first[row + 1])
            best = (budget + 1, 0)
            spans: list[list[int]] = []  # stretches that can hold the passage; overlapping ones are one
            for begin in own[:, 2].tolist():
                low, high = max(first, begin - budget), min(last, begin + len(pattern) + budget)
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(high, spans[-1][1])
                else:
                    spans.append([low, high])
            for low, high in spans:
                symbols = [text[a:b] for a, b in zip(w.starts[low:high].tolist(), w.ends[low:high].tolist())]
                distance, end = myers(pattern, symbols)
                best = min(best, (distance, low - first + end - 1))
            if best[0] <= budget:
                out.append((row, item, *best))
        return out


def item_blocks(items: DataFrame, item_col: str, item_text: str, rate: float, at_once: int) -> Iterator[Broadcast]:
    """All distinct items, with how often each comes, in blocks of about ``at_once``; only one block passes through the driver at a time."""
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where(F.length("text") > 0)
    wanted = materialize(wanted.groupBy("item", "text").agg(F.count("*").alias("times")), "items")
    blocks = max(1, -(-wanted.count() // at_once))
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == block).collect()
        yield items.sparkSession.sparkContext.broadcast(Items.of([tuple(r) for r in rows], rate))


def benchmark_matches(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", rate: float = ERROR_RATE, at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """(id, item, distance, n_words, last_word) for each row of ``docs`` and each item that it holds.

    A row holds an item if some stretch of its words is within ``rate`` times the
    item's number of words (rounded down) of it in edit distance: words put in,
    left out or replaced. Case, punctuation and white space do not count. n_words
    are the item's, last_word is where the closest stretch ends (from 0).

    An item is cut into budget + 1 pieces, one of which any such stretch holds
    intact; rolling hashes find pieces in whole texts, and each place found is
    verified by Myers' bit-parallel distance. Rows stay where they are; distinct items
    travel to them in blocks of ``at_once``, one pass for each block, so memory is
    bounded however many items there are.

    Null and empty texts, and items without words, match nothing. Repeated rows and
    items give repeated matches. Other columns are not looked at.
    """
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, id_col), (items, item_col)))
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, distance int, n_words int, last_word int, __times long"
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where(F.length("__text") > 0)

    def scan(shared: Broadcast) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            own = shared.value
            found = own.matches(plain_words(batch.column("__text")))
            row, item, distance, last = zip(*found) if found else ((), (), (), ())
            size = [len(own.words[k]) for k in item]
            names = pa.array([own.ids[k] for k in item], ARROW.get(item_kind, pa.string()))
            ids = batch.column("__id").take(pa.array(row, pa.int64()))
            rest = (pa.array(x, pa.int32()) for x in (distance, size, last))
            times = pa.array([own.times[k] for k in item], pa.int64())
            return pa.RecordBatch.from_arrays([ids, names, *rest, times], [id_col, item_col, "distance", "n_words", "last_word", "__times"])

        return map_batches(texts, run, schema, "__text")

    found = reduce(DataFrame.union, map(scan, item_blocks(items, item_col, item_text, rate, at_once)))
    return found.withColumn("__times", F.explode(F.array_repeat(F.lit(True), F.col("__times").cast("int")))).drop("__times")


def without_benchmarks(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    rate: float = ERROR_RATE, at_once: int = ITEMS_AT_ONCE,
) -> DataFrame:
    """The rows of ``docs`` that hold no item (see ``benchmark_matches``), with their columns.

    Decided row by row without a shuffle, so rows that share an id, or have none,
    stand for themselves. Rows with null or empty texts stay.
    """
    left = docs.select(row_of(docs).alias("__row"), F.col(text_col).alias("__text"))
    schema = plus(left, ["__row"], "__text string")

    def scan(rows: DataFrame, shared: Broadcast) -> DataFrame:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            clean = np.ones(batch.num_rows, bool)
            clean[[m[0] for m in shared.value.matches(plain_words(batch.column("__text")))]] = False
            return batch.filter(pa.array(clean))

        return map_batches(rows, run, schema, "__text")

    return reduce(scan, item_blocks(items, item_col, item_text, rate, at_once), left).select("__row.*")
