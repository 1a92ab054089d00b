import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from moodtide.llm import bpe, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"
ODD = ["a", "1", "'s", "'S", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "é", "ſ", "½", "Ⅷ", "語", "😀", "𝐀", "<|endoftext|>", "_", "�", "\x00"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rng.randrange(3)
        if kind == 0:
            out.append("".join(rng.choice(ODD) for _ in range(rng.randrange(40))))
        elif kind == 1:
            out.append("".join(chr(rng.choice([rng.randrange(0x20, 0x7F), rng.randrange(0x3000), rng.randrange(0x10000, 0x1FFFF), rng.randrange(0xE000, 0xFFFF)])) for _ in range(rng.randrange(50))))
        else:
            out.append("".join(rng.choice("abcdefgh ieo") for _ in range(rng.randrange(300))))
    return [*out, "", "the" * 3000, "a" * 5000, " " * 4000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y <|endoftext"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_single_trees_equal_many(library):
    own = bpe.Bpe(bpe.read_vocabulary(PATH))
    words = [w for t in odd_texts(300, 1) for w in own.find(t)]
    for w, ids in zip(words, own.encode_batch(words)):
        assert own.encode_one(w.encode()) == np.frombuffer(ids, "<u4").tolist()


def test_round_trip_equals_library(spark, library):
    rows = [*enumerate(odd_texts(1500, 2)), (-1, None), (7, "again"), (7, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in bpe.round_trip(df, PATH).collect()), key=str)
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_arrays_columns_and_empty_tables(spark, library):
    df = spark.createDataFrame([(1, "To be, or", "x", "y"), (2, None, None, None)], "doc_id long, text string, ids string, decoded string")
    coded = bpe.encode(df, PATH)
    assert {r.doc_id: r.ids for r in coded.collect()} == {1: library.encode("To be, or").ids, 2: []}
    both = bpe.encode(df, PATH, decoded="decoded")
    assert {r.doc_id: (r.ids, r.decoded) for r in both.collect()} == {1: (library.encode("To be, or").ids, "To be, or"), 2: ([], "")}
    back = bpe.decode(coded, PATH)
    assert {r.doc_id: r.decoded for r in back.collect()} == {1: "To be, or", 2: ""}
    assert back.columns == ["doc_id", "text", "ids", "decoded"]
    cut = spark.createDataFrame([(1, library.encode("é語").ids[:-1]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(cut, PATH).collect()} == {1: library.decode(library.encode("é語").ids[:-1]), 2: None}
    assert bpe.round_trip(df.limit(0), PATH).count() == 0 and token_counts.count_tokens(df.limit(0), PATH).count() == 0


def test_counts_equal_library(spark, library, monkeypatch):
    rows = [*enumerate(odd_texts(800, 4)), (-1, None), (7, "again"), (7, "again"), (None, "no id")]
    got = sorted((tuple(r) for r in token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH).collect()), key=str)
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    expected = [(i, len((t or "").encode()), k, k > 512) for (i, t), k in zip(rows, n)]
    assert got == sorted(expected, key=str)


def test_caches_stay_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 50)
    monkeypatch.setattr(token_counts, "CACHED", 50)
    raw = bpe.read_vocabulary(PATH)
    own, counter = bpe.Bpe(raw), token_counts.Counter(token_counts.frequent_lengths(PATH), raw)
    for part in range(20):
        texts = odd_texts(5, part)
        expected = [library.encode(t).ids for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts)] == expected
        assert counter.count_batch(texts) == [len(x) for x in expected]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
