import random
import re

import pytest

from moodtide.llm import decontaminate as D

SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"


def table_distance(pattern, text):
    rows = [[0] * (len(text) + 1)]
    for k, symbol in enumerate(pattern, 1):
        row = [k]
        for j, other in enumerate(text, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (symbol != other)))
        rows.append(row)
    return min(rows[-1])


def words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def test_myers_equals_table():
    rng = random.Random(1)
    for _ in range(300):
        pattern = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 90))]
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 60))]
        best, end = D.myers(pattern, text)
        assert best == table_distance(pattern, text)
        assert best == len(pattern) or table_distance(pattern, text[:end]) == best


def case(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the Of and été ü in thing over x1 12".split()) + rng.choice(["", "", str(rng.randrange(30))])
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 4, 9, 20, 40])))) for k in range(30)]
    items += [(30, None), (31, "..."), (32, items[20][1])]
    docs = []
    for i in range(120):
        w = [word() for _ in range(rng.randrange(60))]
        if i % 2:
            passage = rng.choice(items[:30])[1].split()
            for _ in range(rng.randrange(0, 2 + len(passage) // 4)):
                at = rng.randrange(len(passage) + 1)
                passage[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage
        docs.append((i, "".join(x.upper() + rng.choice([" ", ", ", "\n", " - "]) for x in w)))
    return [*docs, (200, None), (201, ""), (202, items[20][1]), (202, items[20][1]), (None, items[21][1])], items


@pytest.mark.parametrize("at_once", [5000, 7])
def test_matches_equal_brute_force(spark, at_once):
    docs, items = case(at_once)
    expected = []
    for i, t in docs:
        for k, item in items:
            p, w = words(item), words(t)
            if p and w and (d := table_distance(p, w)) <= len(p) // 5:
                expected.append((i, k, d, len(p)))
    out = D.benchmark_matches(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, ITEMS), at_once=at_once)
    assert sorted(((r.doc_id, r.item_id, r.distance, r.n_words) for r in out.collect()), key=str) == sorted(expected, key=str)
    kept = D.without_benchmarks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS), at_once=at_once)
    held = {(i, t) for i, t in docs if any(words(x) and words(t) and table_distance(words(x), words(t)) <= len(words(x)) // 5 for _, x in items)}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in docs if x not in held), key=str)


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three four five", "x", 3), (2, None, None, None)], SCHEMA + ", item_id string, __x int")
    items = spark.createDataFrame([(9, "two three four")], ITEMS)
    assert [(r.doc_id, r.distance) for r in D.benchmark_matches(docs, items).collect()] == [(1, 0)]
    kept = D.without_benchmarks(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
    assert D.benchmark_matches(docs.limit(0), items).count() == 0 and D.benchmark_matches(docs, items.limit(0)).count() == 0
    assert D.without_benchmarks(docs, items.limit(0)).count() == 2


def test_repeated_items_travel_once(spark):
    text = "one two three four five six"
    items = spark.createDataFrame([(1, text)] * 40 + [(2, text + " seven")], "item_id long, text string")
    blocks = [b.value for b in D.item_blocks(items, "item_id", "text", 0.2, 4)]
    assert sorted((i, n) for b in blocks for i, n in zip(b.ids, b.times)) == [(1, 40), (2, 1)]
    docs = spark.createDataFrame([(7, f"so {text} go")], "doc_id long, text string")
    found = D.benchmark_matches(docs, items, at_once=4)
    assert found.columns == ["doc_id", "item_id", "distance", "n_words", "last_word"]
    assert sorted(r.item_id for r in found.collect()) == [1] * 40 + [2]
