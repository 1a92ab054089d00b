"""Embedding near-duplicates: product quantisation with exact bounds, exact cosine last."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.components import components, unite
from moodtide.llm.frames import map_batches, materialize

COSINE = 0.93
SAMPLE = 8_192  # vectors that the codebooks are fitted on, at most
SUBSPACES = 8
CODES = 256  # of each subspace, at most
MOST_LISTS = 1_024
BLOCK = 4_096  # members, and queries, of one list that one call compares
STEP = 256  # queries compared at a time
SLACK = 1e-6  # for rounding in the bounds; the last word has the exact cosine

INDEX = "list int, code binary, error float, probes array<int>"


def kmeans(rows: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """At most ``k`` centres of ``rows``."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        near = nearest(rows, centres)[0]
        total = np.zeros_like(centres)
        np.add.at(total, near, rows)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def squared(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return np.maximum((rows**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * rows @ centres.T, 0)


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = squared(rows, centres)
    return d.argmin(1), d


@dataclass
class Quantizer:
    """coarse: (lists, dim); fine: for each subspace its columns and its codebook of residuals."""

    coarse: np.ndarray
    fine: list[tuple[np.ndarray, np.ndarray]]
    radius: float

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, cosine: float) -> Quantizer:
        coarse = kmeans(sample, lists)
        residual = sample - coarse[nearest(sample, coarse)[0]]
        parts = [p for p in np.array_split(np.arange(sample.shape[1]), SUBSPACES) if len(p)]
        return cls(coarse, [(p, kmeans(residual[:, p], CODES, 6)) for p in parts], float(np.sqrt(2 - 2 * cosine)))

    def index(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """List, code, error of the code, lists to probe, for each unit vector.

        The plane half way between two centres parts their lists, so of two vectors
        of different lists within ``radius`` of each other one is at most half of
        that from the plane. Probing all lists that are no farther misses no pair.
        """
        own, d = nearest(unit, self.coarse)
        residual = unit - self.coarse[own]
        codes = np.empty((len(unit), len(self.fine)), np.uint8)
        for s, (columns, book) in enumerate(self.fine):
            codes[:, s] = nearest(residual[:, columns], book)[0]
            residual[:, columns] -= book[codes[:, s]]
        apart = np.sqrt(squared(self.coarse, self.coarse))[own]
        probed = d - d[np.arange(len(own)), own][:, None] <= self.radius * apart + SLACK
        probed[np.arange(len(own)), own] = True
        error = np.sqrt((residual**2).sum(1))
        return own, codes, error, [np.flatnonzero(p) for p in probed]

    def candidates(self, query: np.ndarray, which: int, codes: np.ndarray, error: np.ndarray) -> np.ndarray:
        """(queries, members) flags: distance to the member's code, by table lookup, within radius plus the code's error."""
        residual = query - self.coarse[which]
        total = np.zeros((len(query), len(codes)), np.float32)
        for s, (columns, book) in enumerate(self.fine):
            table = squared(residual[:, columns], book).astype(np.float32)
            total += np.take(table, codes[:, s], axis=1)
        return total <= (self.radius + error + 1e-4) ** 2


def vectors_of(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dim))
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(dim) < size[:, None]] = flat
    return out


def links_of(cell: pa.Table, quantizer: Quantizer, dim: int, cosine: float) -> pa.Table:
    """Of one list's block of members and block of queries: for each vector the number
    of links found here, and links that join all that are linked here.

    A list's own vectors ask it too. A pair from two lists may be met in both, and
    then counts in the later one.
    """
    is_member = cell.column("member").to_numpy(zero_copy_only=False)
    members, queries = cell.filter(pa.array(is_member)), cell.filter(pa.array(~is_member))
    which = int(cell.column("at")[0].as_py())
    m, q = (vectors_of(t.column("vec").combine_chunks(), dim) for t in (members, queries))
    m_norm, q_norm = np.sqrt((m**2).sum(1)), np.sqrt((q**2).sum(1))
    codes = np.frombuffer(b"".join(members.column("code").to_pylist()), np.uint8).reshape(len(m), -1)
    error = members.column("error").to_numpy()
    m_copies, q_copies = (t.column("copies").to_numpy() for t in (members, queries))
    home = queries.column("home").to_numpy()
    asks = np.zeros((len(m), len(quantizer.coarse)), bool)
    asks[np.repeat(np.arange(len(m)), pc.list_value_length(members.column("probes")).to_numpy()), pc.list_flatten(members.column("probes")).to_numpy()] = True
    names = [(t.column("id").to_pylist(), t.column("h").to_pylist()) for t in (queries, members)]
    number: dict = {}
    q_node, m_node = (np.array([number.setdefault(x, len(number)) for x in zip(*n)], np.int64) for n in names)
    root = np.arange(len(number))
    n_links = np.zeros(len(number), np.int64)
    for a in range(0, len(q), STEP):
        flags = quantizer.candidates(q[a : a + STEP] / q_norm[a : a + STEP, None], which, codes, error)
        rows, cols = np.nonzero(flags)
        rows += a
        keep = np.zeros(len(rows), bool)
        for b in range(0, len(rows), 65_536):
            i, j = rows[b : b + 65_536], cols[b : b + 65_536]
            keep[b : b + 65_536] = np.einsum("ij,ij->i", q[i], m[j]) / (q_norm[i] * m_norm[j]) >= cosine
        keep &= q_node[rows] != m_node[cols]
        keep &= (home[rows] <= which) | ~asks[cols, home[rows]]
        rows, cols = rows[keep], cols[keep]
        np.add.at(n_links, q_node[rows], m_copies[cols])
        other = home[rows] != which
        np.add.at(n_links, m_node[cols[other]], q_copies[rows[other]])
        unite(root, q_node[rows], m_node[cols])
    names = list(number)
    linked = np.flatnonzero(root != np.arange(len(root)))
    counted = np.flatnonzero(n_links)
    take = lambda nodes, k: [names[x][k] for x in nodes]
    none = [None] * len(counted)
    return pa.table(
        {
            "id": pa.array(take(counted, 0) + take(linked, 0), pa.int64()),
            "h": pa.array(take(counted, 1) + take(linked, 1), pa.int64()),
            "n": pa.array(n_links[counted].tolist() + [0] * len(linked), pa.int64()),
            "to_id": pa.array(none + take(root[linked], 0), pa.int64()),
            "to_h": pa.array(none + take(root[linked], 1), pa.int64()),
        }
    )


def usable(vec: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    inner = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(inner & F.exists(vec, lambda x: x != 0), F.lit(False))


def link_embeddings(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
    block: int = BLOCK, sample: int = SAMPLE,
) -> DataFrame:
    """id, n_links (long), component_id, kept (boolean) of each row of ``vectors``.

    Rows with equal labels, not null, are linked if their cosine, in double
    precision, is at least ``cosine``. n_links counts the other rows linked
    directly, component_id is the smallest id reachable by links, the row's own
    included, and kept says whether it is the row's own.

    Equal vectors of a label become one before any comparison. Coarse lists and
    codebooks of residual subspaces are fitted on a bounded sample, every vector is
    indexed. Each vector probes all lists that can hold a neighbour (a bound, not
    a number of probes); within a list, distances to the codes come from lookup
    tables, and a member stays a candidate while its code's own error leaves room
    for the radius; candidates are judged by exact cosine. No step can lose a link.
    A list and its queries are cut into blocks, so no task meets more than
    ``block`` members and queries at once, whatever share of all rows a label or a
    list has. A task returns a count for each query and a forest of its links.

    A null, zero, null-holding or non-finite vector, and one without a label, links
    with nothing. Shorter vectors count as filled up with zeros. Repeated rows link
    with each other; a null id never names a component unless all ids in it are
    null, and kept is then true. An empty table gives an empty table.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    rows = rows.withColumn("ok", usable(F.col("vec")) & F.col("label").isNotNull())
    good = rows.where("ok").select("id", "label", "vec")
    distinct = good.groupBy("label", "vec").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    distinct = distinct.withColumn("h", F.xxhash64("label", "vec"))
    nodes = materialize(distinct, "distinct-vectors")
    shape = nodes.agg(F.max(F.size("vec")).alias("dim"), F.count("*").alias("n")).first()
    if not shape["n"]:
        marked = rows.withColumns({"n_links": F.lit(0).cast("long"), "component": F.col("id")})
    else:
        marked = _marked(rows, nodes, shape["dim"], shape["n"], cosine, block, sample)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return marked.select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"), kept.alias("kept"))


def _marked(rows: DataFrame, nodes: DataFrame, dim: int, n: int, cosine: float, block: int, sample: int) -> DataFrame:
    spark = nodes.sparkSession
    chosen = nodes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).toArrow().column("vec").combine_chunks()
    fitted = vectors_of(chosen, dim)
    fitted /= np.sqrt((fitted**2).sum(1))[:, None]
    lists = int(np.clip(np.sqrt(n) / 2, 1, MOST_LISTS))
    shared = spark.sparkContext.broadcast(Quantizer.fit(fitted, lists, cosine))

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = vectors_of(batch.column("vec"), dim)
        own, codes, error, probes = shared.value.index(raw / np.sqrt((raw**2).sum(1))[:, None])
        new = [
            pa.array(own, pa.int32()),
            pa.array([c.tobytes() for c in codes], pa.binary()),
            pa.array(error, pa.float32()),
            pa.array(probes, pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "list", "code", "error", "probes"])

    plain = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    indexed = materialize(map_batches(nodes, index, f"{plain}, {INDEX}"), "indexed-vectors")
    probing = indexed.select("label", F.explode("probes").alias("at"))
    sizes = indexed.groupBy("label", F.col("list").alias("at")).agg(F.count("*").alias("n_members"))
    asked = probing.groupBy("label", "at").agg(F.count("*").alias("n_queries"))
    parts = sizes.join(asked, ["label", "at"]).select(
        "label", "at", F.ceil(F.col("n_members") / block).cast("int").alias("m_parts"), F.ceil(F.col("n_queries") / block).cast("int").alias("q_parts")
    )
    spread = lambda seed, n: F.pmod(F.xxhash64("h", "id", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    fields = ["label", "at", "m", "q", "member", "id", "h", "vec", "copies", "code", "error", "probes", "home"]
    members = indexed.withColumnRenamed("list", "at").join(parts, ["label", "at"]).withColumns({"m": spread(1, "m_parts"), "q": every("q_parts"), "member": F.lit(True), "home": F.col("at")})
    bare = {"code": F.lit(None).cast("binary"), "error": F.lit(None).cast("float"), "probes": F.lit(None).cast("array<int>"), "member": F.lit(False)}
    queries = indexed.select("label", "id", "h", "vec", "copies", F.col("list").alias("home"), F.explode("probes").alias("at")).join(parts, ["label", "at"])
    queries = queries.withColumns({"q": spread(2, "q_parts"), "m": every("m_parts"), **bare})
    cells = members.select(*fields).union(queries.select(*fields))
    found = cells.groupBy("label", "at", "m", "q").applyInArrow(
        lambda cell: links_of(cell, shared.value, dim, cosine), "id long, h long, n long, to_id long, to_h long"
    )
    found = materialize(found, "vector-links")
    node = F.struct("id", "h")
    joined = components(found.where("to_h is not null").select(node.alias("a"), F.struct(F.col("to_id").alias("id"), F.col("to_h").alias("h")).alias("b")))
    counts = found.groupBy("id", "h").agg(F.sum("n").alias("n"))
    both = nodes.select("label", "vec", "copies", "id", "h", node.alias("node")).join(joined, "node", "left")
    both = both.withColumn("component", F.coalesce("component", "node"))
    least = both.groupBy("component").agg(F.min("id").alias("least"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("k"))
    facts = both.join(least, "component").join(counts.select(F.col("id").alias("i"), F.col("h").alias("k"), "n"), same, "left")
    facts = facts.select("label", "vec", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = rows.where("ok").join(facts, ["label", "vec"]).select("id", "n_links", F.col("least").alias("component"))
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone)
