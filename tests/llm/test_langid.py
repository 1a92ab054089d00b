import random
import zlib

import numpy as np
import pytest

from moodtide.llm import langid

SCHEMA = "doc_id long, text string, lang string"
WORDS = {"en": "the of and thing with that ed".split(), "fr": "le été eau ç leux une oui".split(), "de": "der über nicht ä sch ung".split()}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    rows = [(i, prose(rng, lang := rng.choice("en en fr de".split()), rng.randrange(5, 90)), lang) for i in range(400)]
    rows += [(1000, None, "en"), (1001, "", "fr"), (1002, "12 34 !!", "de"), (1003, prose(rng, "en", 30_000), None), (None, prose(rng, "de", 40), "de")]
    return rows + [rows[7], rows[7]]


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    net = langid.Network.fresh(["a", "b", "c"], 4, 1)
    data = rng.integers(0, 256, (7, 5))
    data[4:, 2] = langid.PAD
    target = np.array([0, 1, 2, 0, 1])
    for w, g in zip(net.weights(), net.gradient(data, target)[1]):
        for _ in range(20):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if w is net.table:
                at = (*at[:2], int(rng.choice(data[:4].ravel())))
            old, high_low = w[at], []
            for step in (1e-5, -1e-5):
                w[at] = old + step
                high_low.append(net.gradient(data, target)[0])
            w[at] = old
            assert abs((high_low[0] - high_low[1]) / 2e-5 - g[at]) < 1e-7


def test_fast_pass_equals_plain_forward():
    rng = np.random.default_rng(1)
    net = langid.Network.fresh(["a", "b"], 8, 3).compact()
    data = rng.integers(0, 256, (20, 6))
    logits = net.forward(data)[0]
    p = np.exp(logits - logits.max(1, keepdims=True))
    assert np.allclose(net.probabilities(data), p / p.sum(1, keepdims=True), atol=1e-5)


def test_blocks_pool_to_whole_texts():
    net = langid.Network.fresh(["a", "b"], 8, 3).compact()
    texts = [b"x" * 700, b"", b"abc", bytes(range(1, 200)) * 3]
    offsets = np.cumsum([0, *map(len, texts)])
    total, count = langid._pooled(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for k, t in enumerate(texts):
        own = np.zeros(2)
        for a in range(0, len(t), langid.BLOCK):
            own += net.probabilities(np.frombuffer(t[a : a + langid.BLOCK], np.uint8)[:, None])[:, :, 0].sum(0)
        assert np.allclose(total[k], own, atol=1e-3) and count[k].sum() == len(t)


def test_held_out_accuracy(spark, corpus):
    df = spark.createDataFrame(corpus, SCHEMA).repartition(3)
    texts, targets = langid.sample(df, "doc_id", "text", "lang", n_docs=60)
    assert max(targets.count(x) for x in WORDS) <= 60 and set(targets) == set(WORDS)
    net = langid.train(texts, targets, rounds=120)
    out = langid.identify(df.withColumn("held", langid.held_out("doc_id")), net).collect()
    assert len(out) == len(corpus)
    for r in out:
        assert r.held == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score, r.n_positions) == ("und", 0.0, None)
        else:
            assert 0 < r.score <= 1 and sum(r.n_positions) == len(r.text.encode())
    judged = [r.lang_pred == r.lang for r in out if r.held and r.doc_id < 1000]
    assert np.mean(judged) > 0.95


def test_learning_never_sees_held_out_rows(spark):
    rows = [(i, f"text number {i}", "en" if zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i in range(100)]
    assert set(langid.sample(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "lang")[1]) == {"en"}


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], SCHEMA)
    out = langid.identify(df, langid.learn(df)).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in out} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert langid.identify(df.limit(0), langid.learn(df.limit(0))).count() == 0


def test_rows_that_nothing_is_learned_from_do_not_thin_the_sample(spark):
    rows = [(i, f"text number {i}" if i < 200 else "12 34", "en") for i in range(20_000)]
    learnable = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(200))
    df = spark.createDataFrame(rows, SCHEMA)
    assert len(langid.sample(df, "doc_id", "text", "lang", n_docs=50)[0]) == 50
    more = [(10**6 + i, "held out", "en") for i in range(20_000) if zlib.crc32(str(10**6 + i).encode()) % 4 == 2]
    both = df.union(spark.createDataFrame(more, SCHEMA))
    assert langid.sample(both, "doc_id", "text", "lang", n_docs=50) == langid.sample(df, "doc_id", "text", "lang", n_docs=50)
    assert len(langid.sample(df, "doc_id", "text", "lang", n_docs=300)[0]) == learnable


def test_too_many_languages_are_refused(spark, monkeypatch):
    import pytest

    from moodtide.llm import langid

    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rows = spark.createDataFrame([(i, "some text", f"l{i % 9}") for i in range(90)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="over 3 values of lang"):
        langid.learn(rows)
    assert len(langid.learn(rows.where("lang in ('l1', 'l2')")).labels) == 2
