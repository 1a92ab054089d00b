"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle."""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from moodtide.llm import bpe
from moodtide.llm.frames import map_batches, text_buffers

LIMIT = 512
CACHED = 250_000  # lengths of rarer pre-tokens that a worker remembers


def frequent_lengths(path: str) -> bytes:
    """The first tier: every vocabulary entry that is a pre-token of its own, with its number of tokens.

    The vocabulary lists what was frequent where it was made, so no pass over the
    corpus is needed, and its size bounds the table. Packed as UTF-8 entries, their
    ends and their lengths.
    """
    vocabulary = bpe.Bpe(bpe.read_vocabulary(path))
    entries = []
    for raw in vocabulary.bytes_of.values():
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if vocabulary.find(text) == [text]:
            entries.append(text)
    lengths = [len(x) // 4 for x in vocabulary.encode_batch(entries)]
    table = pa.table({"text": pa.array(entries), "n": pa.array(lengths, pa.uint16())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


class Counter:
    """Lengths of pre-tokens: the table of frequent ones, then this worker's cache."""

    def __init__(self, table: bytes, vocabulary: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        rows = pa.ipc.open_stream(table).read_all()
        self.frequent = dict(zip(rows.column("text").to_pylist(), rows.column("n").to_pylist()))
        self.split = bpe.shared(vocabulary)._split
        self.special = dict.fromkeys(bpe.shared(vocabulary).special, 1)
        self.library = Tokenizer.from_str(vocabulary.decode())
        self.lengths: dict[str, int] = self.frequent | self.special

    def count_batch(self, texts: list[str]) -> list[int]:
        split = [self.split(t) for t in texts]
        wanted = set().union(*split)
        missing = [p for p in wanted if p not in self.lengths]
        if len(self.lengths) + len(missing) > CACHED + len(self.frequent):
            # The table and what was met first, which is mostly what is met often.
            self.lengths = dict(itertools.islice(self.lengths.items(), len(self.frequent) + CACHED // 2))
            missing = [p for p in wanted if p not in self.lengths]
        coded = self.library.encode_batch_fast(missing, add_special_tokens=False)
        self.lengths.update((p, len(c)) for p, c in zip(missing, coded))
        get = self.lengths.__getitem__
        return [sum(map(get, parts)) for parts in split]


@functools.lru_cache(2)
def shared(table: bytes, vocabulary: bytes) -> Counter:
    return Counter(table, vocabulary)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of each row.

    n_tokens is what the tokenizers library with the byte-level BPE file at
    ``path`` gives for the whole text without added special tokens; a special
    token's string inside a text is one token. Frequent pre-tokens are looked up
    in a broadcast table that the vocabulary's size bounds; the others are encoded
    once and remembered by each worker, up to a bound. Nothing is shuffled. Null
    and empty texts have 0 bytes and 0 tokens; repeated rows are counted each.
    """
    spark = docs.sparkSession.sparkContext
    table, vocabulary = spark.broadcast(frequent_lengths(path)), spark.broadcast(bpe.read_vocabulary(path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(text_col)
        counter = shared(table.value, vocabulary.value)
        n = np.array(counter.count_batch([t or "" for t in column.to_pylist()]), np.int64)
        size = np.diff(text_buffers(column)[1])
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
            [id_col, "n_bytes", "n_tokens", "over_limit"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean", text_col)
