"""Pruned exact search: equal to the search over everything, whatever the vectors."""

import numpy as np
import pyarrow as pa
import pytest

from moodtide.operators import pivots, retrieval

DOCS, QUERIES = "doc_id long, embedding array<double>, topic int", "query_id long, embedding array<double>, topic int"


def clustered(n, dim=6, groups=12, spread=0.05, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dim))


def odd(k):
    """Vectors that end a careless search."""
    return [(k, None), (k + 1, []), (k + 2, [None, 1.0]), (k + 3, [float("nan")] * 6), (k + 4, [float("inf"), 0.0]), (k + 5, [1.0, 2.0]), (k + 6, [0.0] * 6)]


def frames(spark, docs, queries):
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(docs)] + [(i, v, 0) for i, v in odd(10_000)]
    rows += [(20_000 + i, rows[7][1], 1) for i in range(len(rows) // 2)]  # one vector in a third of all rows
    asks = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(queries)] + [(i, v, 1) for i, v in odd(500)]
    return spark.createDataFrame(asks, QUERIES), spark.createDataFrame(rows, DOCS).repartition(4)


def found(hits):
    return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 6)) for r in hits.collect())


@pytest.mark.parametrize("kind", retrieval.SIMILARITIES)
def test_equals_the_search_over_everything(spark, kind):
    queries, docs = frames(spark, clustered(900), clustered(40, seed=2))
    want = found(retrieval.top_k(queries, docs, 7, kind))
    assert {r[0] for r in want} == set(range(40)) | {501, 505, 506}
    for sample, at_once in ((8192, 4096), (40, 9)):
        index = pivots.build(docs, kind, sample=sample, docs_a_list=20)
        assert index.table.count() == docs.count() - 4
        got = found(pivots.search(queries, index, 7, at_once))
        # A zero vector is as near to all: it may name any, so its scores are compared.
        key = lambda rows: [(q, r, d if q < 500 else 0, s) for q, r, d, s in rows]
        assert key(got) == key(want)


def test_most_lists_are_skipped(spark):
    docs, queries = clustered(4000, groups=60), clustered(50, groups=60, seed=1)
    _, frame = frames(spark, docs, queries)
    index = pivots.build(frame, "cosine", sample=2000, docs_a_list=50)
    rows = index.table.toPandas().sort_values(["pivot", "reach"], kind="stable")
    assert rows["pivot"].nunique() > 50
    points = pivots.placed(queries, "cosine")
    floor = pivots._floors(points, pivots.placed(index.sample, "cosine"), "cosine", 5)
    scan = pivots.Scan(np.arange(50), queries, floor, index.pivots, "cosine", 5)
    scan.add(pa.RecordBatch.from_pandas(rows, preserve_index=False))
    out = scan.rows()
    assert scan.skipped > 5 * scan.compared
    every = retrieval._similarity(queries, np.stack([np.pad(v, (0, 6 - len(v))) for v in rows["embedding"]]), "cosine")
    best = -np.sort(-every, axis=1)[:, :5]
    got = [sorted((s for q, s in zip(out.column("query_id").to_pylist(), out.column("score").to_pylist()) if q == k), reverse=True) for k in range(50)]
    assert np.allclose(got, best)


def test_a_stored_list_is_read_in_order_of_pivots(spark):
    _, docs = frames(spark, clustered(500), [])
    table = pivots.build(docs, docs_a_list=25).table
    for batch in table.mapInArrow(lambda batches: (b.select(["pivot"]) for b in batches), "pivot int").toArrow().to_batches():
        seen = batch.column("pivot").to_pylist()
        assert sum(a != b for a, b in zip(seen, seen[1:])) < 2 * len(set(seen)) + 4


def test_empty_sides(spark):
    queries, docs = frames(spark, clustered(20), clustered(3))
    assert pivots.search(queries.limit(0), pivots.build(docs), 3).count() == 0
    assert pivots.search(queries, pivots.build(docs.limit(0)), 3).count() == 0
    with pytest.raises(ValueError, match="unknown similarity"):
        pivots.build(docs, "nearest")


def test_all_of_a_topic_are_compared_whatever_their_vectors(spark):
    queries, docs = frames(spark, clustered(60), clustered(4))
    hits = retrieval.top_k(queries, docs, 3, by_topic=True).collect()
    assert {r["query_id"] for r in hits} == {0, 1, 2, 3, 501, 505, 506}
