"""Exact top-k similarity search that leaves out whole lists of documents by the triangle inequality.

Documents are stored clustered by the nearest of some pivots. With the distance from
a query to a pivot and the range of distances from that pivot to the documents of a
list, no document of the list is nearer to the query than the difference; a list
whose best possible similarity is below the query's k-th best so far is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from moodtide.operators.retrieval import HITS, QUERIES_AT_ONCE, SIMILARITIES, _keep_best, matrix, usable
from moodtide.session import materialize

SAMPLE = 8_192  # documents that pivots are chosen from, and that give the first k-th best, at most
DOCS_A_LIST = 256  # wanted; there are MOST_PIVOTS lists at most
MOST_PIVOTS = 4_096
CELLS = 1 << 20  # similarities held at once by a task
SLACK = 1e-9  # of the bounds, for rounding


@dataclass
class PivotIndex:
    """table: (doc_id, embedding, pivot, reach) sorted by pivot in each file; reach is the distance to the pivot."""

    table: DataFrame
    pivots: np.ndarray
    sample: np.ndarray
    kind: str


def placed(vectors: np.ndarray, kind: str) -> np.ndarray:
    """The points whose distances decide: unit vectors for cosine; a zero vector stays where it is."""
    if kind != "cosine":
        return vectors
    size = np.sqrt((vectors**2).sum(1))
    return vectors / np.where(size > 0, size, 1)[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T, 0))


def build(docs: DataFrame, kind: str = "cosine", sample: int = SAMPLE, docs_a_list: int = DOCS_A_LIST) -> PivotIndex:
    """Stores (doc_id, embedding) clustered by pivot.

    Pivots are documents of a bounded sample, spread out by taking each time the one
    farthest from those taken. Every document is stored, in the list of its nearest
    pivot. A list that holds a third of all documents is split over many files.
    Documents without a usable vector (see ``retrieval.usable``) are left out.
    """
    if kind not in SIMILARITIES:
        raise ValueError(f"unknown similarity {kind!r}; known: {SIMILARITIES}")
    rows = docs.select("doc_id", "embedding").where(usable("embedding"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    dim = size["dim"] or 0
    drawn = rows.select("embedding").orderBy(F.xxhash64("doc_id", "embedding"), "embedding").limit(sample).toArrow()
    drawn = matrix(drawn.column("embedding").combine_chunks(), dim)
    pivots = _spread(placed(drawn, kind), int(np.clip(size["n"] / docs_a_list, 1, MOST_PIVOTS)))
    shared = docs.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = distances(placed(matrix(batch.column("embedding"), dim), kind), shared.value)
                near = d.argmin(1)
                columns = [*batch.columns, pa.array(near, pa.int32()), pa.array(d[np.arange(len(near)), near])]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "pivot", "reach"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    listed = rows.mapInArrow(assign, f"{fields}, pivot int, reach double")
    table = materialize(listed.hint("rebalance", "pivot").sortWithinPartitions("pivot", "reach"), "pivot-index")
    return PivotIndex(table, pivots, drawn, kind)


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` distinct points, each the farthest from those before it."""
    if not len(points):
        return points
    chosen = [0]
    far = distances(points, points[:1])[:, 0]
    while len(chosen) < n and far.max() > 1e-6:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


class Scan:
    """The k best documents of each query among the batches met; counts the pairs of query and list compared and skipped."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, index_pivots: np.ndarray, kind: str, k: int):
        self.ids, self.kind, self.k = ids, kind, k
        self.raw, self.points = vectors, placed(vectors, kind)
        self.size = np.sqrt((self.points**2).sum(1))
        self.pivot_size = np.sqrt((index_pivots**2).sum(1))
        self.apart = distances(self.points, index_pivots)
        self.near = self.points @ index_pivots.T
        self.floor = floor.copy()
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.compared = self.skipped = 0

    def most(self, pivot: int, low: float, high: float) -> np.ndarray:
        """For each query the greatest similarity that a document ``low`` to ``high`` from the pivot can have."""
        apart = self.apart[:, pivot]
        if self.kind == "dot":
            return self.near[:, pivot] + self.size * high
        coarse = 1e-7 * (1 + self.size + self.pivot_size[pivot] + high)  # of distances taken by matrix products
        gap = np.maximum(np.maximum(apart - high, low - apart) - coarse, 0)
        return 1 - gap**2 / 2 if self.kind == "cosine" else -gap

    def add(self, batch: pa.RecordBatch) -> None:
        ids, pivots, reach = (batch.column(c).to_numpy() for c in ("doc_id", "pivot", "reach"))
        points = placed(matrix(batch.column("embedding"), self.points.shape[1]), self.kind)
        cuts = [0, *(np.flatnonzero(np.diff(pivots)) + 1), len(pivots)]
        for a, b in zip(cuts, cuts[1:]):
            most = self.most(pivots[a], reach[a:b].min(), reach[a:b].max())
            asks = np.flatnonzero(most >= self.floor - SLACK * (1 + np.abs(self.floor)))
            self.compared += len(asks)
            self.skipped += len(most) - len(asks)
            for start in range(a, b, max(1, CELLS // max(len(asks), 1))):
                stop = min(b, start + max(1, CELLS // max(len(asks), 1)))
                self._compare(asks, points[start:stop], ids[start:stop])

    def _compare(self, asks: np.ndarray, points: np.ndarray, ids: np.ndarray) -> None:
        guess = self.points[asks] @ points.T
        if self.kind == "euclidean":
            guess = -distances(self.points[asks], points)
        floor = self.floor[asks]
        coarse = 1e-6 * (1 + np.abs(floor) + self.size[asks] + np.sqrt((points**2).sum(1)).max())
        i, j = np.nonzero(guess >= (floor - coarse)[:, None])
        q, d = self.points[asks[i]], points[j]
        # The last word has a sum over one pair at a time, which equal documents get alike.
        score = -np.sqrt(((q - d) ** 2).sum(1)) if self.kind == "euclidean" else np.einsum("ij,ij->i", q, d)
        good = score >= floor[i]
        self.found.append((asks[i[good]], score[good], ids[j[good]]))
        self.held += int(good.sum())
        if self.held > 4 * self.k * len(self.ids) + CELLS:
            self._shrink()

    def _shrink(self) -> None:
        """Keeps k of each query and raises its floor to the k-th."""
        if not self.found:
            return
        i, score, ids = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((ids, -score, i))
        i, score, ids = i[order], score[order], ids[order]
        first = np.searchsorted(i, np.arange(len(self.ids) + 1))
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.floor[full] = np.maximum(self.floor[full], score[first[full] + self.k - 1])
        keep = np.arange(len(i)) - first[i] < self.k
        self.found = [(i[keep], score[keep], ids[keep])]
        self.held = int(keep.sum())

    def rows(self) -> pa.RecordBatch:
        self._shrink()
        i, score, ids = self.found[0] if self.found else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(self.ids[i], pa.int64()), pa.array(ids, pa.int64()), pa.array(score)], ["query_id", "doc_id", "score"])


def _floors(points: np.ndarray, sample: np.ndarray, kind: str, k: int) -> np.ndarray:
    """A lower bound of each query's k-th best similarity: that among the sample."""
    if len(sample) < k:
        return np.full(len(points), -np.inf)
    out, step = np.empty(len(points)), max(1, CELLS // len(sample))
    for a in range(0, len(points), step):
        near = points[a : a + step]
        found = -distances(near, sample) if kind == "euclidean" else near @ sample.T
        out[a : a + step] = np.partition(found, len(sample) - k, axis=1)[:, len(sample) - k]
    size = np.sqrt((points**2).sum(1)) + np.sqrt((sample**2).sum(1)).max()
    return out - 1e-6 * (1 + np.abs(out) + size)


def search(queries: DataFrame, index: PivotIndex, k: int = 5, at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """query_id, doc_id, score, rank: the k most similar documents of every query, as ``retrieval.top_k`` finds them.

    Queries travel to the stored lists in blocks of about ``at_once``, one pass for each
    block. A query's k-th best among the index's sample is where it starts; a task
    raises it as it goes and skips every list that cannot reach it. Nothing is lost:
    bounds leave room for rounding, and what passes them is scored exactly. Queries
    without a usable vector find nothing; shorter vectors count as filled up with zeros.
    """
    asked = materialize(queries.select("query_id", "embedding").where(usable("embedding")), "queries")
    blocks = max(1, -(-asked.count() // at_once))
    spark = queries.sparkSession
    known = placed(index.sample, index.kind)
    dim = index.pivots.shape[1] if len(index.pivots) else 0
    hits = [spark.createDataFrame([], HITS)]
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not rows.num_rows or not len(index.pivots):
            continue
        vectors = rows.column("embedding").combine_chunks()
        wide = max(dim, max(vectors.value_lengths().to_pylist()))
        vectors = matrix(vectors, wide)
        pad = lambda x: np.pad(x, ((0, 0), (0, wide - x.shape[1])))
        floor = _floors(placed(vectors, index.kind), pad(known), index.kind, k)
        parts = (rows.column("query_id").to_numpy(), vectors, floor, pad(index.pivots), index.kind, k)
        shared = spark.sparkContext.broadcast(parts)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = Scan(*shared.value)
            for batch in batches:
                if batch.num_rows:
                    best.add(batch)
            yield best.rows()

        hits.append(index.table.mapInArrow(scan, HITS))
    return _keep_best(reduce(DataFrame.union, hits), k)
