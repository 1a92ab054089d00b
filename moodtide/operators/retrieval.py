"""Batch top-k similarity search and its evaluation."""

from __future__ import annotations

from functools import reduce
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

HITS = "query_id bigint, doc_id bigint, score double"
SIMILARITIES = ("cosine", "dot", "euclidean")

QUERIES_AT_ONCE = 4096  # query vectors that travel with the tasks; more queries take more passes
SCORE_CELLS = 4 << 20  # scores held at once by a task


def _similarity(queries: np.ndarray, docs: np.ndarray, kind: str) -> np.ndarray:
    """(queries x docs) similarities; a zero vector is similar to nothing."""
    if kind == "euclidean":
        squares = (queries**2).sum(1)[:, None] + (docs**2).sum(1)[None, :]
        return -np.sqrt(np.maximum(squares - 2 * queries @ docs.T, 0.0))
    if kind == "cosine":
        queries = queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)
        docs = docs / np.maximum(np.linalg.norm(docs, axis=1, keepdims=True), 1e-300)
    return queries @ docs.T


def _first(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores per row, the lower position first on ties.

    Only rows with a tie at the k-th place need a whole sort.
    """
    if scores.shape[1] <= k:
        return np.argsort(-scores, axis=1, kind="stable")
    best = np.sort(np.argpartition(-scores, k - 1, axis=1)[:, :k], axis=1)
    values = np.take_along_axis(scores, best, axis=1)
    order = np.take_along_axis(best, np.argsort(-values, axis=1, kind="stable"), axis=1)
    lowest = values.min(axis=1, keepdims=True)
    tied = np.flatnonzero((scores >= lowest).sum(axis=1) > k)
    order[tied] = np.argsort(-scores[tied], axis=1, kind="stable")[:, :k]
    return order


def _best(query_vectors, doc_ids, doc_vectors, k: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the top-k documents of one batch for each query, by score then id."""
    by_id = np.argsort(doc_ids, kind="stable")
    doc_ids, doc_vectors = doc_ids[by_id], doc_vectors[by_id]
    step = max(1, SCORE_CELLS // max(len(doc_ids), 1))
    scores, ids = [], []
    for start in range(0, len(query_vectors), step):
        found = _similarity(query_vectors[start : start + step], doc_vectors, kind)
        order = _first(found, k)
        scores.append(np.take_along_axis(found, order, axis=1))
        ids.append(doc_ids[order])
    return np.concatenate(scores), np.concatenate(ids)


def _merged(scores: np.ndarray, ids: np.ndarray, more_scores: np.ndarray, more_ids: np.ndarray):
    """The best of both for each query, in the order of ``_best``; as many as ``scores`` has."""
    k = scores.shape[1]
    scores, ids = np.concatenate([scores, more_scores], 1), np.concatenate([ids, more_ids], 1)
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def usable(name: str) -> Column:
    """Whether a vector can be compared: not null, and no null or non-finite component."""
    vector = F.col(name)
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as doubles, shorter ones filled up with zeros, longer ones cut."""
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == dim).all():
        return flat.astype("float64").reshape(len(column), dim)
    out = np.zeros((len(column), max(dim, int(size.max(initial=0)))))
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out[:, :dim]


def _widest(column: pa.Array, dim: int) -> int:
    return max(dim, int(column.value_lengths().to_numpy().max(initial=0)))


def _keep_best(hits: DataFrame, k: int) -> DataFrame:
    """Merge partial top-k lists; already limited to k per task and query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 5,
    kind: str = "cosine",
    by_topic: bool = False,
    at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """The k most similar documents of every query, exactly.

    ``queries`` holds (query_id, embedding), ``docs`` holds (doc_id, embedding),
    both also ``topic`` when only documents of the query's topic may match.
    Documents stay where they are, none is copied or shuffled: queries travel to
    them in blocks of ``at_once``, one pass over the documents for each block. A
    task keeps the k best of each query and compares by matrix product.

    Queries and documents whose vector is null or holds null or non-finite components
    take no part; shorter vectors count as filled up with zeros. ``pivots`` has a
    stored index that skips most documents.
    """
    if kind not in SIMILARITIES:
        raise ValueError(f"unknown similarity {kind!r}; known: {SIMILARITIES}")
    extra = ["topic"] if by_topic else []
    queries = queries.select("query_id", "embedding", *extra).where(usable("embedding"))
    docs = docs.select("doc_id", "embedding", *extra).where(usable("embedding"))
    blocks = max(1, -(-queries.count() // at_once))
    hits = []
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toArrow()
        if rows.num_rows or blocks == 1:
            hits.append(_scan(docs, rows.combine_chunks(), k, kind, by_topic))
    return _keep_best(reduce(DataFrame.union, hits), k)


def _scan(docs: DataFrame, rows: pa.Table, k: int, kind: str, by_topic: bool) -> DataFrame:
    """Top-k lists of one block of queries, one for each task with documents."""
    n = rows.num_rows
    columns = [rows.column(c).combine_chunks() if n else None for c in rows.column_names]
    ids = columns[0].to_numpy() if n else np.zeros(0, np.int64)
    vectors = matrix(columns[1], _widest(columns[1], 0)) if n else np.zeros((0, 0))
    topics = columns[2].to_numpy(zero_copy_only=False) if n and by_topic else None
    shared = docs.sparkSession.sparkContext.broadcast((ids, vectors, topics))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, topics = shared.value
        scores, best = np.full((len(ids), k), -np.inf), np.full((len(ids), k), -1, np.int64)
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            wide = _widest(batch.column("embedding"), vectors.shape[1])
            vectors = np.pad(vectors, ((0, 0), (0, wide - vectors.shape[1])))
            doc_ids, doc_vectors = batch.column("doc_id").to_numpy(), matrix(batch.column("embedding"), wide)
            if topics is None:
                pairs = [(slice(None), slice(None))]
            else:
                own = batch.column("topic").to_numpy(zero_copy_only=False)
                pairs = [(topics == t, own == t) for t in np.unique(topics) if (own == t).any()]
            for q, d in pairs:
                found = _best(vectors[q], doc_ids[d], doc_vectors[d], k, kind)
                scores[q], best[q] = _merged(scores[q], best[q], *found)
        real = scores > -np.inf
        columns = [np.repeat(ids, k)[real.ravel()], best[real], scores[real]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "doc_id", "score"])

    return docs.mapInArrow(scan, HITS)


def passages(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Hits as passages: text, score and citation metadata."""
    cited = [c for c in ("url", "title", "source", "topic", "retrieved_at") if c in chunks.columns]
    entries = F.map_from_arrays(
        F.array(*[F.lit(c) for c in cited]),
        F.array(*[F.coalesce(F.col(c), F.lit("")) for c in cited]),
    )
    return hits.join(chunks, "doc_id").select(
        "query_id", "rank", "text", "score", entries.alias("metadata")
    )


def topic_centroids(docs: DataFrame) -> DataFrame:
    """Mean vector per topic: one query for each topic, whatever the corpus size."""
    placed = docs.select("topic", F.posexplode("embedding").alias("i", "x"))
    means = placed.groupBy("topic", "i").agg(F.avg("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))  # one entry per dimension
    return means.groupBy("topic").agg(F.transform(ordered, lambda e: e["x"]).alias("embedding"))


def evaluate(
    hits: DataFrame, query_topics: DataFrame, doc_topics: DataFrame, k: int
) -> DataFrame:
    """Precision@k and recall@k per backend; a hit is relevant if topics agree.

    Relevant documents are counted per topic, never paired with queries.
    """
    judged = hits.join(query_topics.withColumnRenamed("topic", "query_topic"), "query_id").join(
        doc_topics, "doc_id"
    )
    per_query = judged.groupBy("backend", "query_id", "query_topic").agg(
        F.count_if(F.col("topic") == F.col("query_topic")).alias("found")
    )
    relevant = doc_topics.groupBy(F.col("topic").alias("query_topic")).agg(
        F.count(F.lit(1)).alias("relevant")
    )
    scored = per_query.join(relevant, "query_topic", "left")
    return scored.groupBy("backend").agg(
        F.avg(F.col("found") / F.lit(k)).alias("context_precision"),
        F.avg(F.coalesce(F.try_divide("found", "relevant"), F.lit(0.0))).alias("context_recall"),
    )


def compare_backends(evaluation: DataFrame, backends: list[str]) -> DataFrame:
    """One row per metric, one column per backend."""
    long = evaluation.unpivot(
        "backend", ["context_precision", "context_recall"], "metric", "value"
    )
    return long.groupBy("metric").pivot("backend", backends).agg(F.first("value"))
