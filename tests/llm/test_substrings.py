import random
import re
from collections import Counter

import pytest

from moodtide.llm.substrings import dedup_substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of a and é to in ww x-y 12 z,".split())
    passage = [word() for _ in range(30)]
    long = [word() + str(k) for k in range(60)]
    rows = []
    for i in range(60):
        w = [word() + str(rng.randrange(50)) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(5) :]
        if i % 7 == 0:
            w += long
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
    rows += [(100, None), (101, ""), (102, " \n "), (103, "a " * 900), (104, "a b " * 40), rows[5], rows[5], (5, "other"), (None, rows[7][1]), (None, None)]
    return rows


@pytest.mark.parametrize("window, minimiser, hot", [(12, 4, 10**6), (12, 4, 2), (35, 8, 10**6), (35, 8, 1)])
def test_equals_brute_force(spark, window, minimiser, hot):
    rows = corpus(window + hot % 7)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = dedup_substrings(df, window=window, minimiser=minimiser, hot_runs=hot)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect())
    assert got == brute(rows, window)


def test_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x", 9), (2, "z a b c d e f", None, None)], "doc_id long, text string, key string, n_words int")
    rows = dedup_substrings(df, window=5, minimiser=2).orderBy("doc_id").collect()
    assert [(r.key, r.n_words, r.n_removed, r.kept_text) for r in rows] == [("x", 6, 6, ""), (None, 7, 6, "z")]
    assert dedup_substrings(df.limit(0)).count() == 0
