"""Vector code compression: integer product codes, assigned along a trie of distinct parts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from moodtide.llm.embeddings import vectors_of
from moodtide.llm.frames import materialize

PARTS = 16
ENTRIES = 64  # of each part's codebook; two hex digits name up to 256
ROUNDS = 2
SCALE = 256.0
RUN = 4_096  # leaves whose distance vectors are held at once
SMALL = 1 << 26  # up to here squared distances and sums fit 64 bits; beyond it Python's integers take over
MOST = (1 << 63) - 1


def finite(vec: Column) -> Column:
    """Not null, and no null or non-finite component, also after scaling."""
    scaled = lambda x: F.abs(x.cast("double") * SCALE) < float("inf")
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & scaled(x)), F.lit(False))


def integers(vectors: np.ndarray) -> np.ndarray:
    """(rows, PARTS, width) components floor(SCALE * x), exact whatever their size; short ends are filled up with zeros."""
    scaled = np.floor(vectors * SCALE)
    out = np.zeros((len(scaled), -(-scaled.shape[1] // PARTS) * PARTS))
    out[:, : scaled.shape[1]] = scaled
    whole = out.astype(np.int64) if np.abs(out).max(initial=0) <= SMALL else np.array([[int(x) for x in row] for row in out], object)
    return whole.reshape(len(out), PARTS, out.shape[1] // PARTS)


def distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, how often each occurs, and which of them each row is."""
    keys = parts
    if parts.dtype == object:
        keys = np.stack([np.unique(column, return_inverse=True)[1] for column in parts.T], 1)
    order = np.lexsort(keys.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    new = np.ones(len(parts), bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(1)
    first = np.flatnonzero(new)
    which = np.empty(len(parts), np.int64)
    which[order] = np.cumsum(new) - 1
    return parts[order[first]], np.diff(np.append(first, len(parts))), which


def assign(parts: np.ndarray, entries: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the lower index on ties) and squared distance of each of ``parts``, rows in lexicographic order.

    The rows are the leaves of a trie with one level for each dimension. A node's
    vector holds, for each entry, the squared distance over the dimensions down to
    the node, and is its parent's plus one term, so rows with a common prefix share
    the work on it. Leaves are visited depth first, ``run`` of them at a time; the
    path to the last leaf is carried to the next run, and nothing else is.
    """
    n, width = parts.shape
    code, error = np.empty(n, np.int64), np.empty(n, parts.dtype)
    path: list[np.ndarray] = [np.empty(0)] * width
    for a in range(0, n, run):
        leaves = parts[a : a + run]
        new = np.ones((len(leaves), width), bool)
        begin = a == 0
        differ = leaves[begin:] != parts[a - 1 + begin : a - 1 + len(leaves)]
        new[begin:] = np.logical_or.accumulate(differ, axis=1)
        vectors, node = np.zeros((1, len(entries)), parts.dtype), np.zeros(len(leaves), np.int64)
        for d in range(width):
            at = np.flatnonzero(new[:, d])
            grown = vectors[node[at]] + (leaves[at, d][:, None] - entries[:, d]) ** 2
            if not new[0, d]:
                grown = np.concatenate([path[d][None], grown])
            vectors, node = grown, np.cumsum(new[:, d]) - new[0, d]
            path[d] = vectors[-1]
        best = vectors.argmin(1)
        code[a : a + run] = best[node]
        error[a : a + run] = vectors[np.arange(len(best)), best][node]
    return code, error


def _assigned(batch: pa.RecordBatch, dim: int, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: its number, distinct parts, their counts, entries and errors, and which of them each row has."""
    whole = integers(vectors_of(batch.column("vec"), dim))
    if books.dtype == object:
        whole = whole.astype(object)
    for p in range(PARTS):
        leaves, n, which = distinct(whole[:, p])
        code, error = assign(leaves, books[p].astype(leaves.dtype))
        yield p, leaves, n, code, error, which


def _moved(kept: DataFrame, books: np.ndarray, dim: int) -> np.ndarray:
    """The codebooks after one round; a task sends one row for each entry that it used."""
    shared = kept.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        total, used = np.zeros(books.shape, object), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, leaves, n, code, _, _ in _assigned(batch, dim, books):
                part = np.zeros(books.shape[1:], leaves.dtype)
                np.add.at(part, code, leaves * n[:, None])
                total[p] += part.astype(object)
                np.add.at(used[p], code, n)
        p, k = np.nonzero(used)
        columns = [pa.array(p, pa.int32()), pa.array(k, pa.int32()), pa.array(used[p, k], pa.int64())]
        columns.append(pa.array([[str(x) for x in row] for row in total[p, k]], pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays(columns, ["p", "k", "n", "total"])

    def added(group: pa.Table) -> pa.Table:
        total = [str(sum(map(int, column))) for column in zip(*group.column("total").to_pylist())]
        first = {name: [group.column(name)[0].as_py()] for name in ("p", "k")}
        return pa.table(
            {
                "p": pa.array(first["p"], pa.int32()),
                "k": pa.array(first["k"], pa.int32()),
                "n": pa.array([sum(group.column("n").to_pylist())], pa.int64()),
                "total": pa.array([total], pa.list_(pa.string())),
            }
        )

    schema = "p int, k int, n long, total array<string>"
    out = books.astype(object)
    for row in kept.mapInArrow(sums, schema).groupBy("p", "k").applyInArrow(added, schema).collect():  # PARTS * ENTRIES rows at most
        out[row["p"], row["k"]] = [int(x) // row["n"] for x in row["total"]]
    return _narrow(out)


def _narrow(books: np.ndarray) -> np.ndarray:
    """As 64-bit integers where squares of differences fit, which is not so for entries beyond SMALL."""
    return books.astype(np.int64) if all(abs(x) <= SMALL for x in books.ravel()) else books.astype(object)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def learn(kept: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, int]:
    """(PARTS, entries, width) codebooks for (id, vec) and the longest vector's length.

    Codebooks start as the parts of the vectors with the smallest ids; equal ids are
    taken by their vectors, null ids last.
    """
    dim = kept.agg(F.max(F.size("vec"))).first()[0] or 0
    first = kept.orderBy(F.asc_nulls_last("id"), "vec").limit(entries).select("vec").toArrow().column("vec").combine_chunks()
    books = integers(vectors_of(first, dim)).transpose(1, 0, 2)
    books = _narrow(books)
    for _ in range(rounds if len(first) else 0):
        books = _moved(kept, books, dim)
    return books, dim


def encode(kept: DataFrame, books: np.ndarray, dim: int) -> DataFrame:
    """id, code, error and label of each of (id, vec, label): two hex digits a part, and the squared distance to the entries."""
    shared = kept.sparkSession.sparkContext.broadcast(books)
    fields = [kept.schema["id"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), kept.schema["label"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, errors = np.empty((batch.num_rows, PARTS), np.uint8), np.zeros(batch.num_rows, object)
            for p, _, _, code, error, which in _assigned(batch, dim, shared.value):
                codes[:, p] = code[which]
                errors += error[which].astype(object)
            columns = [batch.column("id"), pa.array([c.tobytes().hex() for c in codes]), pa.array([min(x, MOST) for x in errors], pa.int64()), batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, ["id", "code", "error", "label"])

    return kept.mapInArrow(run, T.StructType(fields))


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """id, code, error, label_error, codebooks_sha256 of each vector kept.

    Components become floor(256 * x), vectors are cut into 16 equal parts, and each
    part is named by the nearest of its codebook's ``entries``, which ``rounds``
    rounds of assigning and averaging have moved (floors go down, ties go to the
    lower index, unused entries stay). All arithmetic is on whole numbers.

    Vectors stay where they are: a task makes a trie of the distinct parts of each
    batch, with their counts as weights, so copies cost nothing, and sends one row
    of sums for each entry. Only codebooks (``entries`` rows) pass the driver. Errors
    are summed by label before the table of sums meets the rows.

    Null vectors and those that hold null or non-finite components are dropped, so
    an empty table gives an empty one, as does one without any vector left. Shorter
    vectors count as filled up with zeros, an empty one as all zeros. Repeated rows
    are all kept and all count; null ids come last in the start of the codebooks.
    An error beyond a long is the largest long. Other columns are not looked at.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits names 1 to 256 entries")
    columns = [F.col(f"`{c}`").alias(name) for c, name in ((id_col, "id"), (vec_col, "vec"), (label_col, "label"))]
    kept = materialize(vectors.select(*columns).where(finite(F.col("vec"))), "kept-vectors")
    books, dim = learn(kept, entries, rounds)
    coded = materialize(encode(kept, books, dim), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    by_label = materialize(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label-errors")
    both = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return both.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
