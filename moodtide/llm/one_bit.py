"""Nearest neighbours by inner product: one-bit codes of rotated vectors estimate, error bounds choose, exact products rank."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from moodtide.llm.embeddings import usable, vectors_of
from moodtide.llm.frames import map_batches, materialize, scratch_dir

K = 20
BITS_PER_DIMENSION = 2  # short vectors are filled up with zeros before the rotation, which makes longer, truer codes
BOUND = 4.0  # standard deviations of the estimate that a vector is given the benefit of
SAMPLE = 8_192  # vectors whose exact products give a first lower bound of the k-th best, at most
QUERIES_AT_ONCE = 8_192  # that travel with the tasks; more queries take more passes
CELLS = 1 << 21  # estimates held at a time
PAIRS = 1 << 16  # exact products taken at a time
SEED = 11

FOUND = "key long, vec_id long, score double, own boolean"


def rotation(bits: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    return q * np.sign(np.diag(r))


def bits_of(dim: int) -> int:
    return -(-max(dim, 1) * BITS_PER_DIMENSION // 8) * 8


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the rotated rows, and two scalars of each: ``scale`` and ``spread``.

    With s the signs divided by the root of the number of bits, o the rotated vector
    and c the cosine between them, scale is |o| / c and <q, s> * scale estimates
    <q, o>. What it leaves out is the part of o across s against the part of q across
    s: of a random rotation, |q| * spread is its standard deviation.
    """
    bits = len(turn)
    turned = vectors @ turn[: vectors.shape[1]]
    size = np.sqrt((turned**2).sum(1))
    cosine = np.abs(turned).sum(1) / np.sqrt(bits) / size
    spread = size * np.sqrt(np.maximum(1 - cosine**2, 0)) / cosine / np.sqrt(max(bits - 1, 1))
    return np.packbits(turned >= 0, axis=1), size / cosine, spread


def signs(codes: np.ndarray) -> np.ndarray:
    """Packed codes as rows of +-1 over the root of the number of bits."""
    flat = np.unpackbits(codes, axis=1).astype(np.float32)
    return (2 * flat - 1) / np.float32(np.sqrt(flat.shape[1]))


def products(queries: np.ndarray, vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of queries[i] and vectors[j], summed from the first component to the last (both given transposed)."""
    out = np.zeros(len(i))
    for a in range(0, len(i), PAIRS):
        part, p, q = out[a : a + PAIRS], i[a : a + PAIRS], j[a : a + PAIRS]
        for x, y in zip(queries, vectors):
            part += x[p] * y[q]
    return out


class Block:
    """Queries of one pass, with a lower bound of each one's k-th best product."""

    def __init__(self, key: np.ndarray, vectors: np.ndarray, floor: np.ndarray, turn: np.ndarray):
        self.key, self.floor, self.turn = key, floor, turn
        self.columns = np.ascontiguousarray(vectors.T)
        self.size = np.sqrt((vectors**2).sum(1))
        unit = vectors / np.maximum(self.size, np.finfo(float).tiny)[:, None]
        self.turned = (unit @ turn[: vectors.shape[1]]).astype(np.float32)


class Best:
    """The k best of each query met so far, by product, then id."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.floor = block.floor.copy()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, batch: pa.RecordBatch) -> None:
        dim = len(self.block.columns)
        vectors = vectors_of(batch.column("vec"), dim)
        columns = np.ascontiguousarray(vectors.T)
        codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(vectors), -1)
        ids, scale, spread = (batch.column(c).to_numpy() for c in ("id", "scale", "spread"))
        sign = signs(codes).T
        room = BOUND * spread + 1e-5 * scale  # with some for the rounding of single precision
        step = max(1, CELLS // len(vectors))
        for a in range(0, len(self.block.key), step):
            most = (self.block.turned[a : a + step] @ sign) * scale + room
            i, j = np.nonzero(most * self.block.size[a : a + step, None] >= self.floor[a : a + step, None])
            i += a
            score = products(self.block.columns, columns, i, j)
            good = score >= self.floor[i]
            i, j, score = i[good], j[good], score[good]
            self.parts.append((i, score, ids[j], (vectors[j] == self.block.columns.T[i]).all(1)))
            self.held += len(i)
        if self.held > 4 * self.k * max(len(self.block.key), 1 << 12):
            self.shrink()

    def shrink(self) -> None:
        """Keeps k of each query and raises the floors to the k-th product."""
        if not self.parts:
            return
        i, score, ids, own = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -score, i))
        i, score, ids, own = i[order], score[order], ids[order], own[order]
        first = np.searchsorted(i, np.arange(len(self.block.key) + 1))
        place = np.arange(len(i)) - first[i]
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.floor[full] = np.maximum(self.floor[full], score[first[full] + self.k - 1])
        keep = place < self.k
        self.parts = [(i[keep], score[keep], ids[keep], own[keep])]
        self.held = int(keep.sum())

    def rows(self) -> pa.RecordBatch:
        self.shrink()
        i, score, ids, own = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool))
        columns = [pa.array(self.block.key[i], pa.int64()), pa.array(ids, pa.int64()), pa.array(score, pa.float64()), pa.array(own)]
        return pa.RecordBatch.from_arrays(columns, ["key", "vec_id", "score", "own"])


def index(vectors: DataFrame, copies: int) -> tuple[DataFrame, np.ndarray, int]:
    """(id, vec, code, scale, spread) of the rows of (id, vec), the rotation and the number of dimensions.

    Of equal vectors only the ``copies`` smallest ids can be among the nearest, so
    only those get a row; map tasks limit them before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    first = materialize(vectors.withColumn("place", place).where(F.col("place") <= copies).drop("place"), "first-copies")
    dim = first.agg(F.max(F.size("vec"))).first()[0] or 0
    turn = rotation(bits_of(dim))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, scale, spread = encode(vectors_of(batch.column("vec"), dim), turn)
        new = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(spread)]
        return pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "code", "scale", "spread"])

    kind = first.schema["vec"].dataType.simpleString()
    indexed = map_batches(first, run, f"id long, vec {kind}, code binary, scale double, spread double")
    return materialize(indexed, "one-bit-index"), turn, dim


def _floors(queries: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """A lower bound of each query's k-th best product: its k-th best among the sample, less some rounding."""
    if len(sample) < k:
        return np.full(len(queries), -np.inf)
    out, step = np.empty(len(queries)), max(1, CELLS // len(sample))
    for a in range(0, len(queries), step):
        found = queries[a : a + step] @ sample.T
        out[a : a + step] = np.partition(found, len(sample) - k, axis=1)[:, len(sample) - k]
    size = np.sqrt((queries**2).sum(1)) * np.sqrt((sample**2).sum(1)).max()
    return out - 1e-9 * size


def nearest(queries: DataFrame, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, at_once: int = QUERIES_AT_ONCE, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of ``vectors`` with the largest inner product for each row of ``queries``.

    Products are taken in double precision from the first component to the last; ties
    go to the smaller id. A query's own row, the one with its id and vector, is no
    candidate; one with another vector under the same id is.

    Vectors are rotated at random and become one bit a component, with two scalars.
    Codes and scalars estimate all products of a block of queries with a batch of
    vectors by one matrix product, and the estimate's error bound says which pairs
    are worth an exact product: those that may reach the k-th best found so far,
    which starts as the k-th best of a bounded sample. The bound is one of chance, of
    BOUND standard deviations: a neighbour just at the edge is missed once in some
    thirty thousand times. Vectors stay where they are, queries travel in blocks of about
    ``at_once``, one pass for each block, and a task returns k rows a query at most.
    Equal vectors are one query, and of equal candidates only the k + 1 smallest ids
    get a row, so a vector that a third of all rows hold costs no more than others.

    Vectors that are null, zero or hold null or non-finite components take no part,
    nor do rows without an id, which no result could name; shorter vectors count as
    filled up with zeros. Rows equal in id and vector count once. With fewer
    candidates than k all are returned; without queries or candidates the result is
    empty. Other columns are not looked at.
    """
    indexed, turn, dim = index(_usable(vectors, id_col, vec_col), k + 1)
    asked = materialize(_usable(queries, id_col, vec_col).withColumn("key", F.xxhash64("vec")), "queries")
    distinct = materialize(asked.select("key", "vec").dropDuplicates(["key"]), "distinct-queries")
    blocks = -(-distinct.count() // at_once)
    spark = vectors.sparkSession
    chosen = indexed.select("vec").orderBy(F.xxhash64("vec", "id"), "vec").limit(sample).toArrow().column("vec").combine_chunks()
    few = vectors_of(chosen, dim)
    found = scratch_dir(spark, "nearest")
    spark.createDataFrame([], FOUND).write.parquet(found)
    for block in range(blocks if len(few) else 0):
        rows = distinct.where(F.pmod("key", F.lit(blocks)) == block).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        own = rows.column("vec").combine_chunks()
        own = vectors_of(own, max(dim, max(own.value_lengths().to_pylist())))[:, :dim]
        shared = spark.sparkContext.broadcast(Block(rows.column("key").to_numpy(), own, _floors(own, few, k + 1), turn))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = Best(shared.value, k + 1)
            for batch in batches:
                if batch.num_rows:
                    best.add(batch)
            yield best.rows()

        indexed.mapInArrow(scan, FOUND).write.mode("append").parquet(found)
    return _ranked(asked, spark.read.schema(FOUND).parquet(found), k)


def _usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    picked = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
    return picked.where(usable(F.col("vec")) & F.col("id").isNotNull()).distinct()


def _ranked(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The lists of all tasks merged to one of k + 1 for each vector, and without its own row of k for each query."""
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
    first = found.withColumn("place", place).where(F.col("place") <= k + 1)
    lists = first.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("list"))
    both = asked.join(lists, "key").select(F.col("id").alias("query_id"), "list")
    others = F.slice(F.filter("list", lambda x: ~(x["own"] & (x["vec_id"] == F.col("query_id")))), 1, k)
    each = both.select("query_id", F.posexplode(others).alias("at", "hit"))
    return each.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
