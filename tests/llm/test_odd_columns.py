"""Every operator beside columns with odd names, or with names that it might use itself."""

import pytest

from moodtide.llm import (
    bpe,
    chat,
    decontaminate,
    embeddings,
    importance,
    langid,
    licenses,
    one_bit,
    simhash,
    substrings,
    token_counts,
    urls,
    vector_codes,
)
from moodtide.llm.queries import vocabulary_path

ODD = (
    "my col", "a.b", "x`y", "__id", "__t0", "__t1", "__letters", "letters_0", "covers", "row", "id", "first", "key", "label2", "rank", "score", "vec", "text2",
    "node", "bucket", "component", "h", "place", "code", "error", "digit", "block", "at", "own", "lang_pred2", "n_words2", "segments", "shape",
)
PASSAGE = " ".join(f"w{i}" for i in range(60))
TEXTS = [f"the first text, {PASSAGE} and more", f"another text; {PASSAGE}", "Released under the MIT License.", None, "", "short one"]


def beside(spark, rows, schema):
    """``rows`` with all odd columns, one of them a struct of more fields than a short form prints."""
    wide = "struct<" + ", ".join(f"`f {i}`: int" for i in range(40)) + ">"
    odd = [name for name in ODD if f"{name} " not in schema]
    names = ", ".join(f"`{n.replace('`', '``')}` string" for n in odd)
    value = tuple(range(40))
    return spark.createDataFrame([(*r, *[f"v{k}" for k in range(len(odd))], value) for r in rows], f"{schema}, {names}, `wide one` {wide}")


@pytest.fixture
def docs(spark):
    return beside(spark, [(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")


def kept(df, out, n=None):
    """The odd columns of ``out`` are those of ``df``."""
    assert set(df.columns) <= set(out.columns)
    rows = out.collect()
    assert n is None or len(rows) == n
    assert all(r["my col"] == "v0" and r["a.b"] == "v1" and tuple(r["wide one"]) == tuple(range(40)) for r in rows)
    return rows


def test_operators_that_keep_all_columns(spark, docs):
    items = beside(spark, [(1, PASSAGE)], "item_id long, text string")
    kept(docs, substrings.dedup_substrings(docs), 6)
    assert len(kept(docs, decontaminate.without_benchmarks(docs, items))) == 4
    assert {r["doc_id"] for r in kept(docs, simhash.keep_one_of_each(docs))} >= {2, 3, 5}
    kept(docs, simhash.fingerprint(docs), 6)
    net = langid.learn(docs)
    kept(docs, langid.identify(docs, net), 6)
    coded = bpe.encode(docs, vocabulary_path(), ids="ids")
    kept(docs, coded, 6)
    kept(docs, bpe.decode(coded, vocabulary_path()), 6)


def test_operators_that_return_their_own_columns(spark, docs):
    items = beside(spark, [(1, PASSAGE)], "item_id long, text string")
    assert decontaminate.benchmark_matches(docs, items).count() == 2
    assert simhash.group_near_copies(docs).count() == 6
    assert token_counts.count_tokens(docs, vocabulary_path()).count() == 6
    assert bpe.round_trip(docs, vocabulary_path()).count() == 6
    assert licenses.scan_licenses(docs.withColumn("source", docs.lang), licenses.source_path()).count() == 6
    assert importance.resample(docs, items).count() == 6
    pages = beside(spark, [(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    labels = beside(spark, [(1, 0, 1)], "doc_id long, quality int, toxic int")
    assert urls.filter_urls(pages, labels).count() == 2
    vectors = beside(spark, [(0, [1.0, 2.0], 1), (20, [1.0, 2.1], 1), (3, None, 1)], "vec_id long, embedding array<float>, label int")
    assert embeddings.link_embeddings(vectors).count() == 3
    assert one_bit.nearest(vectors.where("vec_id % 20 = 0"), vectors).count() == 2
    assert vector_codes.compress(vectors).count() == 2
    turns = beside(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "ho")], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(turns)).count() == 1


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    beside(spark, [(1, PASSAGE)], "item_id long, text string").select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = docs.withColumns({"source": docs.lang, "n_chars": docs.doc_id})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, str(tmp_path))
        kept(rows, out)
        assert out.columns[: len(rows.columns)] == rows.columns
