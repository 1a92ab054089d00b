import math

import numpy as np
import pytest

from moodtide.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine):
    good = [
        k for k, (_, v, label) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    dim = max((len(rows[k][1]) for k in good), default=0)
    x = np.zeros((len(good), dim), np.float32)
    for a, k in enumerate(good):
        x[a, : len(rows[k][1])] = rows[k][1]
    x = x.astype(float)
    norm = np.sqrt((x**2).sum(1))
    labels = np.array([rows[k][2] for k in good])
    linked = (x @ x.T / np.outer(norm, norm) >= cosine) & (labels[:, None] == labels) & ~np.eye(len(good), dtype=bool)
    comp = list(range(len(good)))
    for _ in comp:
        comp = [min([comp[a], *(comp[b] for b in np.flatnonzero(linked[a]))]) for a in range(len(good))]
    ids = [rows[k][0] for k in good]
    out = [(i, 0, i, True) for k, (i, _, _) in enumerate(rows) if k not in good]
    for a, i in enumerate(ids):
        least = min((ids[b] for b in range(len(ids)) if comp[b] == comp[a] and ids[b] is not None), default=None)
        out.append((i, int(linked[a].sum()), least, least is None or i is None or i == least))
    return sorted(out, key=str)


def vectors(seed, n=260, dim=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(14, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(14)] + rng.normal(size=dim) * rng.choice([0.05, 0.22, 1.0])
        rows.append((i, [float(x) for x in v * rng.choice([1, 3])], int(rng.integers(3)) if i % 9 else None))
    rows += [(900, None, 1), (901, [0.0] * dim, 1), (902, [1.0, None], 1), (903, [float("nan")] * dim, 1), (904, [float("inf"), 1.0], 2), (905, [], 1)]
    rows += [rows[3], rows[3], (906, rows[3][1], rows[3][2]), (3, rows[4][1], 2), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0), (909, [-0.0, 1.0], 0), (910, [0.0, 1.0], 0)]
    return rows


@pytest.mark.parametrize("block, sample", [(4096, 8192), (16, 40)])
def test_equals_brute_force(spark, block, sample):
    rows = vectors(block)
    out = E.link_embeddings(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block, sample=sample)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, E.COSINE)


def test_probes_and_bounds_lose_nothing():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 24))
    x[1500:] = x[:1500] + rng.normal(size=(1500, 24)) * rng.uniform(0.1, 0.6, (1500, 1))
    x /= np.sqrt((x**2).sum(1))[:, None]
    quantizer = E.Quantizer.fit(x[::10], 30, 0.93)
    own, codes, error, probes = quantizer.index(x)
    pairs = np.argwhere((x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool))
    assert len(pairs) > 500
    for a, b in pairs:
        assert own[b] in probes[a] or own[a] in probes[b]
        assert quantizer.candidates(x[a : a + 1], own[b], codes[b : b + 1], error[b : b + 1]).all()
    assert np.mean([len(p) for p in probes]) < 15


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0], 1, "x", 2.0), (2, [1.0, 0.01], 1, None, None)], SCHEMA + ", list string, n_links double")
    assert sorted(map(tuple, E.link_embeddings(df).collect())) == [(2, 1, 2, True), (5, 1, 2, False)]
    assert E.link_embeddings(df.limit(0)).count() == 0
    assert [tuple(r) for r in E.link_embeddings(df.where("vec_id = 5").withColumn("label", df.label * None)).collect()] == [(5, 0, 5, True)]


def test_links_just_above_and_below_the_threshold(spark):
    """Thousands of vectors, a third under one label: pairs at 0.929 to 0.931, chains of near pairs, copies. No link is lost or made up."""
    rng = np.random.default_rng(9)
    dim, rows = 32, []

    def turned(v, cosine):
        """A unit vector with this cosine to the unit vector v."""
        w = rng.normal(size=dim)
        w -= (w @ v) * v
        return cosine * v + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)

    label = lambda: 0 if rng.random() < 1 / 3 else int(rng.integers(1, 40))
    for _ in range(900):
        v, own = rng.normal(size=dim), label()
        v /= np.linalg.norm(v)
        rows += [(v * rng.uniform(0.1, 9), own), (turned(v, rng.uniform(0.929, 0.931)), own)]
    for _ in range(40):  # chains, of which only neighbours are linked
        v, own = rng.normal(size=dim), label()
        v /= np.linalg.norm(v)
        for _ in range(12):
            rows.append((v, own))
            v = turned(v, 0.94)
    rows += [(rows[0][0], rows[0][1])] * 300
    x = np.array([v for v, _ in rows], np.float32)
    labels = np.array([own for _, own in rows])
    ids = rng.permutation(len(rows))
    df = spark.createDataFrame([(int(i), v.tolist(), int(k)) for i, v, k in zip(ids, x, labels)], SCHEMA).repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.link_embeddings(df).collect()}
    unit = x.astype(float)
    norm = np.sqrt((unit**2).sum(1))
    linked = (unit @ unit.T / np.outer(norm, norm) >= E.COSINE) & (labels[:, None] == labels) & ~np.eye(len(x), dtype=bool)
    assert {int(i): int(n) for i, n in zip(ids, linked.sum(1))} == {i: n for i, (n, _) in got.items()}
    least = ids.copy()
    while True:
        best = np.minimum(least, np.where(linked, least, len(ids)).min(1))
        if (best == least).all():
            break
        least = best
    assert {int(i): int(c) for i, c in zip(ids, least)} == {i: c for i, (_, c) in got.items()}
    near = linked[np.arange(0, 1800, 2), np.arange(1, 1800, 2)]
    assert 300 < near.sum() < 600  # about half of the pairs at the threshold are linked
