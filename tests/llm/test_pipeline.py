"""The pipeline's stages on a small corpus with planted cases, each against brute force or what was planted."""

import random
import re
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.test_decontaminate import table_distance, words
from tests.llm.test_langid import WORDS

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", rng.choice("bdgkmt") + str(rng.randrange(500))]) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = {i: (prose(rng, lang := rng.choice(["en", "fr", "de"]), rng.randrange(60, 200)), lang) for i in range(150)}
    items = [(k, prose(rng, "en", 30)) for k in range(6)]
    passage = prose(rng, "en", 55)
    rows[200] = rows[3]  # exact copy
    near = rows[4][0].split()
    near[10] = "other"
    rows[201] = (" ".join(near), rows[4][1])
    for i in (20, 21, 22):
        rows[i] = (f"{rows[i][0]} {passage} {prose(rng, 'en', 20)}", rows[i][1])
    rows[30] = (f"{rows[30][0]} {items[2][1].upper()} tail", "en")
    edited = items[3][1].split()
    edited[4:6] = ["changed"]
    rows[31] = (f"start {' '.join(edited)} {rows[31][0]}", "en")
    rows |= {300: (None, "en"), 301: ("", None), 302: ("1234 5678 !!", "fr"), 303: (rows[5][0] + " <|endoftext|>", None)}
    data = [(i, t, lang, f"src{i % 3}", None if t is None else len(t)) for i, (t, lang) in rows.items()]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(data, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, data, items, passage


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    """What each stage was given and returned."""
    path, out = tables[0], []
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        where = str(tmp_path_factory.mktemp(name))
        stage(spark, docs, path).write.mode("overwrite").parquet(where)
        after = spark.read.parquet(where)
        out.append((docs, after))
        docs = after
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes
    assert stages[-1][1].columns == [*stages[0][0].columns, "token_ids", "n_tokens", "round_trip"]


def test_language_stage_keeps_prose(stages):
    before, after = map(by_id, stages[0])
    assert set(before) - set(after) == {300, 301, 302}


def test_one_of_near_copies_stays(stages):
    before, after = map(by_id, stages[1])
    assert set(before) - set(after) == {200, 201, 303}


def test_passages_go(stages, tables):
    before, after = map(by_id, stages[2])
    tokens = {i: r.text.split() for i, r in before.items()}
    seen = Counter(tuple(w[k : k + 35]) for w in tokens.values() for k in range(len(w) - 34))
    for i, w in tokens.items():
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        assert after[i].text == (" ".join(x for k, x in enumerate(w) if k not in gone) if gone else before[i].text)
        assert after[i].n_chars == len(after[i].text) and bool(gone) == (i in (20, 21, 22))


def test_benchmark_documents_go(stages, tables):
    before, after = map(by_id, stages[3])
    held = {i for i, r in before.items() if any(table_distance(words(x), words(r.text)) <= len(words(x)) // 5 for _, x in tables[2])}
    assert held == {30, 31} and set(after) == set(before) - held


def test_encoding(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in stages[4][1].collect():
        assert r.token_ids == library.encode(r.text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.token_ids) and r.round_trip


def test_run_equals_the_stages(spark, tables, stages):
    rows = driver.queries()["pipeline"](spark, tables[0])
    assert sorted(map(str, rows.collect())) == sorted(map(str, stages[-1][1].collect()))


def test_every_operator_is_registered():
    names = set(driver.queries())
    assert all(any(re.match(rf"op{n}_", x) for x in names) for n in range(1, 11))


def test_empty_documents(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables[0])
    assert docs.count() == 0
