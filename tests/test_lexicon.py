"""All lexicons in one pass: the same figures as one search for each term, at a cost that does not grow with the terms."""

import random
import time

import pytest

from moodtide.functions import text as T
from moodtide.operators.lexicon import Lexicons, lexicon_hits


def test_equals_one_search_for_each_term(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abA é\n", [6, 4, 1, 2, 1, 1], k=rng.randrange(60))) for _ in range(300)] + ["", None, "İ" * 5, "aaaaaaa"]
    lists = {"x": ["a", "aa", "aba", "ab", "b a", "é"], "y": ["aa", "aaa", "bab", "aa"], "none": [], "z": ["not there", "i̇"]}
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, `my col` string").repartition(3)
    out = lexicon_hits(df.withColumn("x_count", T.word_count("text")), lists)
    assert out.columns == ["id", "text", "my col", *[f"{k}_{s}" for k in lists for s in ("distinct", "count")]]
    for name, terms in lists.items():
        once = list(dict.fromkeys(terms))
        want = df.select("id", T.distinct_hits("text", once).alias("d"), T.count_hits("text", once).alias("c")).collect()
        null = {r["id"] for r in df.where("text is null").collect()}
        got = {r["id"]: (r[f"{name}_distinct"], r[f"{name}_count"]) for r in out.collect()}
        assert {k: v for k, v in got.items() if k not in null} == {r["id"]: (r["d"], r["c"]) for r in want if r["id"] not in null}
        assert all(got[k] == (None, None) for k in null)


def test_cost_does_not_grow_with_the_terms():
    rng = random.Random(5)
    body = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(150_000))

    def seconds(n):
        terms = {"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(n)}
        lexicons = Lexicons({"x": terms})
        start = time.perf_counter()
        lexicons.hits(body)
        return time.perf_counter() - start

    few, many = (min(seconds(n) for _ in range(3)) for n in (10, 1000))
    assert many < 6 * few  # a hundred times the terms


def test_no_rows_and_empty_terms(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert lexicon_hits(df, {"x": ["a"]}).count() == 0
    with pytest.raises(ValueError, match="empty term"):
        Lexicons({"x": [""]})
