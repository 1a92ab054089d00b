"""Importance resampling: documents drawn by how much more their n-grams belong to a target than to the corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.frames import cut, materialize, text_buffers
from moodtide.llm.radix import ranked
from moodtide.llm.word_crc import joined, word_crcs
from moodtide.llm.words import find

BUCKETS = 10_000
PERCENT = 5
MIN_WORDS = 20
BINS = 65_536  # of the histogram that leaves out scores far below the draw
SEED = 42
WORDS_AT_ONCE = 1 << 18


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased, and which bytes part words: all below 0x80 but digits and letters."""
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    parts = np.ones(256, bool)
    parts[ord("0") : ord("9") + 1] = parts[ord("a") : ord("z") + 1] = parts[0x80:] = False
    return lower, parts


LOWER, PARTS_WORDS = _tables()


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text; and (row, bucket) of each run of one to three words, some at a time."""
    raw, offsets = text_buffers(texts)
    words = find(LOWER[raw], offsets, PARTS_WORDS)

    def each() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n = len(words.starts)
        for a in range(0, n, WORDS_AT_ONCE):
            b, over = min(a + WORDS_AT_ONCE, n), min(a + WORDS_AT_ONCE + 2, n)  # runs that begin before b
            starts, ends, row = words.starts[a:over], words.ends[a:over], words.doc[a:over]
            one, size = word_crcs(words.raw, starts, ends), ends - starts
            crc = one
            for more in range(3):
                if more:
                    crc = joined(crc[: len(one) - more], one[more:], size[more:])
                own = np.flatnonzero(row[: len(crc)] == row[more:])
                own = own[own < b - a]
                yield row[own], (crc[own] % np.uint32(buckets)).astype(np.int64)

    return np.diff(words.first), each()


def bucket_counts(docs: DataFrame, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one row for each bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in cut(batch, "text"):
                for _, bucket in features(part.column("text"), buckets)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    found = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "bucket int, n long")
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():  # ``buckets`` rows at most
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket 1000 times the log ratio of its smoothed shares, rounded down."""
    k = len(corpus)
    s_all, t_all = float(corpus.sum() + k), float(target.sum() + k)
    ratio = [(float(t) + 1) * s_all / ((float(s) + 1) * t_all) for s, t in zip(corpus, target)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(docs: DataFrame, id_col: str, text_col: str, gain: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight) of each document: the sum of the gains of its features."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for part in cut(batch, "text"):
                n_words, found = features(part.column("text"), len(gain))
                n, weight = (np.zeros(part.num_rows, np.int64) for _ in range(2))
                for row, bucket in found:
                    np.add.at(weight, row, gain[bucket])
                    n += np.bincount(row, minlength=part.num_rows)
                new = [pa.array(x, pa.int64()) for x in (n_words, n, weight)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *new], ["id", "n_words", "n_features", "weight"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return texts.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def noise(key: Column, seed: int = SEED) -> Column:
    """A Gumbel variate in thousandths, rounded down, fixed by the seed and the id (a null id counts as empty)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _candidates(scored: DataFrame, draw: int) -> Column:
    """Of the rows that may be drawn, those whose score can be among the ``draw`` highest: a histogram of BINS bins tells."""
    may = F.col("may")
    ends = scored.where(may).agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    if not draw:
        return F.lit(False)
    width = (ends["high"] - ends["low"]) // BINS + 1
    bin_of = F.floor((F.lit(ends["high"]) - F.col("score")) / F.lit(width))
    seen = last = 0
    for last, n in sorted(scored.where(may).groupBy(bin_of.alias("bin")).count().collect()):  # BINS rows at most
        seen += n
        if seen >= draw:
            break
    return may & (bin_of <= last)


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
    percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
) -> DataFrame:
    """id, n_words, n_features, weight, score, rank of each document; rank is null for those not drawn.

    Features are runs of one to three words, hashed into ``buckets``. A document's
    weight adds up, over its features, how much likelier the target is than the
    corpus; fixed Gumbel noise on top makes the highest scores a draw without
    replacement in proportion to exp(weight / 1000). Of the documents with at least
    ``min_words`` words, ``percent`` in a hundred are drawn, ranked by score, then by
    id (null ids last), then by n_features.

    Both tables are counted and weighed in place, batch by batch, whole texts always;
    what travels are counts by bucket, and the ``buckets`` gains go to the tasks. A
    histogram of scores leaves out what no draw can reach, and a distributed radix
    sort ranks the rest, whatever share of it has one score.

    A null text is empty; a document without words has no features and weight 0.
    Repeated rows are counted, and may be drawn, each. An empty target gives gains all
    the same; an empty table gives an empty table. Other columns are not looked at.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text, buckets))
    weighed = weigh(docs, id_col, text_col, gain)
    scored = weighed.withColumns({"score": F.col("weight") + noise(F.col("id")), "may": F.col("n_words") >= min_words})
    scored = materialize(scored, "scored")
    draw = percent * scored.where("may").count() // 100
    near = _candidates(scored, draw)
    order = [F.bitwise_not("score"), F.col("id").isNull().cast("long"), F.coalesce("id", F.lit(0)), F.col("n_features")]
    best = ranked(scored.where(near), order)
    best = best.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.where(~near).withColumn("rank", F.lit(None).cast("long"))
    every = best.unionByName(rest)
    return every.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
