import math

import numpy as np
import pytest

from moodtide.llm import one_bit as O

SCHEMA = "vec_id long, embedding array<float>, label int"


def good(rows):
    seen = []
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) and (i, v) not in seen:
            seen.append((i, v))
    return seen


def brute(queries, rows, k):
    rows = good(rows)
    dim = max((len(v) for _, v in rows), default=0)
    wide = lambda v: np.array([*v, *[0.0] * dim][:dim], np.float32).astype(float)
    out = []
    for i, v in good(queries):
        q = wide(v)
        best = sorted((-sum(a * b for a, b in zip(q, wide(w))), j) for j, w in rows if (j, w) != (i, v))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def vectors(seed, n=700, dim=20):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32) * rng.choice([0.2, 1, 5], (n, 1)).astype(np.float32)
    x[50:110] = x[50]  # a vector that many rows hold
    rows = [(i, [float(y) for y in v], 1) for i, v in enumerate(x)]
    rows += [(2000, None, 1), (2020, [0.0] * dim, 1), (2040, [1.0, None], 1), (2060, [float("nan")] * dim, 1), (2080, [float("inf"), 1.0], 2), (2100, [], 1)]
    rows += [rows[20], rows[20], (20, rows[30][1], 1), (None, rows[3][1], 1), (2120, [2.0, 1.0], None), (-40, [3.0, -1.0], None), (2140, [1e20] * dim, 1)]
    return rows


@pytest.mark.parametrize("at_once, sample", [(8192, 8192), (9, 64)])
def test_equals_brute_force(spark, at_once, sample):
    rows = vectors(at_once)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = O.nearest(df.where("vec_id % 20 = 0"), df, at_once=at_once, sample=sample).collect()
    want = brute([r for r in rows if r[0] is not None and r[0] % 20 == 0], rows, O.K)
    assert sorted(map(tuple, out)) == want


def test_estimates_keep_their_bounds():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(4000, 64)), rng.normal(size=(200, 64))
    turn = O.rotation(O.bits_of(64))
    assert np.allclose(turn @ turn.T, np.eye(128))
    codes, scale, spread = O.encode(x, turn)
    assert codes.shape == (4000, 16)
    apart = (q @ turn[:64]) @ O.signs(codes).T * scale - q @ x.T
    deviation = apart / (np.sqrt((q**2).sum(1))[:, None] * spread)
    assert abs(deviation.mean()) < 0.02 and 0.8 < deviation.std() < 1.1
    assert (np.abs(deviation) > O.BOUND).mean() < 1e-3


def test_bounds_leave_most_vectors_out(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 64))
    taken = []
    turn, real = O.rotation(O.bits_of(64)), O.products
    monkeypatch.setattr(O, "products", lambda *a: taken.append(len(a[2])) or real(*a))
    import pyarrow as pa

    codes, scale, spread = O.encode(x, turn)
    batch = pa.RecordBatch.from_pydict({"id": np.arange(6000), "vec": list(x), "code": [c.tobytes() for c in codes], "scale": scale, "spread": spread})
    q = x[::60]
    best = O.Best(O.Block(np.arange(100), q, O._floors(q, x[:4000], 21), turn), 21)
    best.add(batch)
    out = best.rows()
    exact = np.argsort(-(q @ x.T), axis=1)[:, :21]
    assert sum(taken) < 0.35 * q.shape[0] * 6000
    got = [set(np.array(out.column("vec_id"))[np.array(out.column("key")) == k]) for k in range(100)]
    assert np.mean([len(g & set(e)) / 21 for g, e in zip(got, exact)]) >= 0.99


def test_few_candidates_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 1, "x", 1), (5, [3.0, 0.0], 1, "y", 2)], SCHEMA + ", key string, `my col` int")
    assert [tuple(r) for r in O.nearest(df.where("vec_id = 0"), df).collect()] == [(0, 1, 5, 3.0)]
    assert O.nearest(df.limit(0), df).count() == 0
    assert O.nearest(df, df.limit(0)).count() == 0
