import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodtide.llm import importance as I, radix, word_crc

DOCS = "doc_id long, text string, lang string"


def grams(text, buckets):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(docs, target, buckets=I.BUCKETS):
    found = [(i, *grams(t, buckets)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in found:
        s.update(f)
    for text in target:
        t.update(grams(text, buckets)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for i, n, f in found:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in rows if r[1] >= I.MIN_WORDS), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for rank, r in enumerate(may[: I.PERCENT * len(may) // 100]):
        r[5] = rank + 1
    return sorted(map(tuple, rows), key=str)


def texts(n=420):
    rng = random.Random(4)
    vocabulary = ["alpha", "Beta", "gäa", "日本", "x", "42", "don't", "e-mail", "Straße", "w" * 70, "q" * 200, "\x00", "Ünïcode", "--", "İ"]
    docs = [(i, rng.choice([" ", "  ", ", ", "\n"]).join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 19, 20, 30, 60])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "..."), docs[5], docs[5], (5, docs[6][1]), (None, docs[9][1]), (None, "alpha " * 25), (-3, "alpha beta " * 30_000)]
    return docs


def test_equals_brute_force(spark, monkeypatch):
    docs, target = texts(), ["alpha beta gäa 42", "x x x", None, "", "alpha beta gäa 42"]
    df = spark.createDataFrame([(i, t, "en") for i, t in docs], DOCS).repartition(3)
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    for buckets in (I.BUCKETS, 7):
        out = I.resample(df, bench, buckets=buckets).collect()
        assert sorted((tuple(r) for r in out), key=str) == brute(docs, target, buckets)
    out = I.resample(df, bench.limit(0)).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(docs, [])


def test_long_texts_are_cut_between_words_only(monkeypatch):
    text = " ".join(f"w{i % 50}" for i in range(1000))
    whole = Counter(b for _, bucket in I.features(pa.array([text, text]), 1000)[1] for b in bucket)
    monkeypatch.setattr(I, "WORDS_AT_ONCE", 7)
    n, parts = I.features(pa.array([text, text]), 1000)
    assert Counter(b for _, bucket in parts for b in bucket) == whole and list(n) == [1000, 1000]


def test_crcs():
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 256, 300_000).astype(np.uint8)
    starts = rng.integers(0, 200_000, 500)
    ends = starts + rng.choice([0, 1, 3, 8, 63, 64, 65, 90_000], 500)
    out = word_crc.word_crcs(raw, starts, ends)
    one = [raw[a:b].tobytes() for a, b in zip(starts, ends)]
    assert out.tolist() == [zlib.crc32(x) for x in one]
    both = word_crc.joined(out[:-1], out[1:], (ends - starts)[1:])
    assert both.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(one, one[1:])]


@pytest.mark.parametrize("digit_bits, block_bits", [(11, 13), (3, 2)])
def test_radix_ranks(spark, digit_bits, block_bits):
    rng = random.Random(digit_bits)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1]
    rows = [(rng.choice([rng.randrange(-5, 5), rng.choice(ends)]), rng.randrange(-(10**6), 10**6) if rng.random() < 0.9 else 7, k) for k in range(200)]
    df = spark.createDataFrame(rows, "`a.b` long, at long, `my col` int").repartition(5)
    out = radix.ranked(df, [F.col("`a.b`"), F.col("at"), F.col("`my col`")], "rank", digit_bits, block_bits).collect()
    assert [tuple(r)[:3] for r in sorted(out, key=lambda r: r["rank"])] == sorted(rows)
    assert sorted(r["rank"] for r in out) == list(range(1, 201))


def test_radix_on_equal_keys_and_empty_tables(spark):
    df = spark.range(100).withColumn("k", F.lit(3))
    assert sorted(r["rank"] for r in radix.ranked(df, [F.col("k")]).collect()) == list(range(1, 101))
    assert radix.ranked(df.limit(0), [F.col("k")]).count() == 0


def test_a_hot_digit_is_split_by_blocks(spark, plan_of):
    df = spark.range(0, 40_000, 1, 4).withColumn("k", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 7))
    out = radix.ranked(df, [F.col("k"), F.col("id")], block_bits=10)
    k, i = F.col("k"), F.col("id")
    assert out.orderBy("rank").select(k, i).collect() == df.orderBy(k, i).select(k, i).collect()


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "one two three " * 10, "en", 1, 2)], DOCS + ", rank int, `my col` int")
    bench = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert [tuple(r)[:3] for r in I.resample(df, bench).collect()] == [(1, 30, 87)]
    assert I.resample(df.limit(0), bench).count() == 0
