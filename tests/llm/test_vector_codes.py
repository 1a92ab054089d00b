import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from moodtide.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, entries, rounds):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [float(np.float32(x)) for x in r[1]]))
    dim = max((len(v) for _, v, _ in kept), default=0)
    width = -(-dim // V.PARTS)
    whole = [[math.floor(256 * Fraction(float(np.float32(x)))) for x in v] for _, v, _ in kept]
    whole = [v + [0] * (width * V.PARTS - len(v)) for v in whole]
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(V.PARTS)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(V.PARTS)]
    nearest = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [[] for _ in book]
            for c in cut:
                own[nearest(c[p], book)[1]].append(c[p])
            books[p] = [tuple(sum(x) // len(o) for x in zip(*o)) if o else e for o, e in zip(own, book)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(V.PARTS)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + min(error, V.MOST)
        out.append((i, "".join(f"{k:02x}" for _, k in found), min(error, V.MOST), label))
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, code, e, min(by_label[label], V.MOST), sha) for i, code, e, label in out), key=str)


def vectors(seed, n=300, dim=32):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, dim)), 1) * 0.02
    x[40:140] = x[40]
    rows = [(i, [float(y) for y in v], int(rng.integers(3)) if i % 7 else None) for i, v in enumerate(x)]
    rows += [(2000, None, 1), (2001, [0.0] * dim, 1), (2002, [1.0, None], 1), (2003, [float("nan")] * dim, 1), (2004, [float("inf"), 1.0], 2)]
    return [*rows, (2005, [], 1), rows[3], rows[3], (3, rows[4][1], 2), (None, rows[5][1], 1), (2006, [0.5, -0.5], 0), (-7, [-0.0] * dim, 0)]


@pytest.mark.parametrize("entries, rounds, large", [(64, 2, False), (5, 3, False), (20, 2, True)])
def test_equals_brute_force(spark, entries, rounds, large):
    rows = vectors(entries, dim=32 if large else 30)
    if large:
        rows += [(-1, [3e38, -2.5e30] + [1e9] * 30, 1), (4000, [-1e12] * 32, 1), (4001, [3e38] * 32, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in V.compress(df, entries=entries, rounds=rounds).collect()), key=str) == brute(rows, entries, rounds)


@pytest.mark.parametrize("run", [1, 7, 4096])
def test_the_trie_finds_the_nearest_entry(run):
    rng = np.random.default_rng(run)
    leaves, n, which = V.distinct(rng.integers(-3, 4, (900, 4)))
    assert n.sum() == 900 and (np.diff([int("".join(str(x + 3) for x in row), 7) for row in leaves]) > 0).all()
    entries = rng.integers(-3, 4, (12, 4))
    code, error = V.assign(leaves, entries, run)
    every = ((leaves[:, None] - entries) ** 2).sum(2)
    assert (code == every.argmin(1)).all() and (error == every.min(1)).all()
    assert [len(x) for x in V.assign(leaves[:0], entries)] == [0, 0]


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(5, [1.0] * 16, 1, "x", 2), (2, [0.5] * 16, 1, None, None)], SCHEMA + ", `code` string, `my col` int")
    out = sorted(map(tuple, V.compress(df).collect()))
    assert [r[:4] for r in out] == [(2, "00" * 16, 0, 0), (5, "01" * 16, 0, 0)]
    assert V.compress(df.limit(0)).count() == 0
    assert V.compress(df.where("vec_id = 2").selectExpr("vec_id", "cast(null as array<float>) embedding", "label")).count() == 0
