"""Byte-level BPE encoding with segment trees, and decoding."""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from moodtide.llm.frames import map_batches, plus

# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 200_000  # pre-tokens that a worker remembers, about 50 MB
LONG = 32  # bytes beyond which a pre-token has a tree of its own and is not remembered
TREES = 16_384  # pre-tokens whose trees are worked on side by side
NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(odd)}


def read_vocabulary(path: str) -> bytes:
    """The file of a byte-level BPE tokenizer, checked to be one that this module can follow."""
    with open(path, "rb") as file:
        raw = file.read()
    spec = json.loads(raw)
    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    odd = (
        spec["normalizer"], spec["post_processor"], model.get("dropout"), model.get("byte_fallback"),
        model.get("ignore_merges"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"),
        split.get("add_prefix_space"), any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]),
    )
    if split.get("type") != "ByteLevel" or model["type"] != "BPE" or not split.get("use_regex", True) or any(odd):
        raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
    return raw


class PreTokens:
    """Splits a text by PATTERN.

    The standard library's ``re`` is twice as fast as ``regex`` but knows no
    Unicode classes, so their ranges below U+10000 are spelled out; a text with
    letters beyond goes through ``regex``.
    """

    def __init__(self) -> None:
        import regex

        self.any = regex.compile(PATTERN).findall
        plane = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
        pattern = PATTERN
        for name in (r"\s\p{L}\p{N}", r"\p{L}", r"\p{N}", r"\s", r"\S"):
            inner = name.replace(r"\S", r"\s")
            spans = (m.group() for m in regex.finditer(f"[{inner}]+", plane))
            ranges = "".join(f"\\u{ord(x[0]):04x}-\\u{ord(x[-1]):04x}" for x in spans)
            pattern = pattern.replace(f"[^{name}]", f"[^{ranges}]").replace(name, f"[^{ranges}]" if name == r"\S" else f"[{ranges}]")
        self.plane = re.compile(pattern).findall

    def __call__(self, text: str) -> list[str]:
        low = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return self.plane(text) if low else self.any(text)


class Bpe:
    """Encodes and decodes texts; made once in each worker (``shared``)."""

    def __init__(self, raw: bytes):
        import regex

        spec = json.loads(raw)
        ids: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        backward = {c: b for b, c in letters.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(backward[c] for c in s) for s, i in ids.items()} | {
            i: s.encode() for s, i in self.special.items()
        }
        self.of_byte = np.array([ids[letters[b]] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.order = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.order]
        self.rank_of = {p: r for r, p in enumerate(pairs.tolist())}
        self.find = PreTokens()
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self.known: dict[str, bytes] = {}

    # --- encoding ---------------------------------------------------------------

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = [self._split(t) for t in texts]
        long = self._learn({p for parts in split for p in parts})
        known = self.known
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for p in long:
            del known[p]
        return out

    def _split(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.find(text)
        out: list[str] = []
        for k, part in enumerate(self.cut(text)):
            out += [part] if k % 2 else self.find(part)
        return out

    def _learn(self, wanted: set[str]) -> list[str]:
        """Makes ``known`` hold all of ``wanted``; returns those too long to stay."""
        new = [p for p in wanted if p not in self.known]
        if len(self.known) + len(new) > CACHED:
            # What was met first is mostly what is met often.
            self.known = dict(itertools.islice(self.known.items(), CACHED // 2))
            new = [p for p in wanted if p not in self.known]
        coded = [p.encode("utf-8", "surrogatepass") for p in new]
        long: list[str] = []
        short: dict[int, list[int]] = {}
        for k, (p, b) in enumerate(zip(new, coded)):
            if p in self.special:
                self.known[p] = np.array([self.special[p]], "<u4").tobytes()
            elif len(b) > LONG:
                long.append(p)
                self.known[p] = np.array(self.encode_one(b), "<u4").tobytes()
            else:
                short.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append(k)
        for width, rows in short.items():
            for a in range(0, len(rows), TREES):
                part = rows[a : a + TREES]
                self.known.update(zip([new[k] for k in part], self._encode_many([coded[k] for k in part], width)))
        return long

    def encode_one(self, word: bytes) -> list[int]:
        """Ids of one pre-token. The tree's root holds the lowest rank of a pair, then the leftmost place."""
        sym = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(sym)
        width = 1 << max(n - 1, 1).bit_length()
        ranks, made = self.rank_of, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [NONE] * (2 * width)

        def leaf(k: int) -> int:
            j = after[k]
            rank = ranks.get(sym[k] << 32 | sym[j]) if j < n else None
            return NONE if rank is None else rank * width + k

        tree[width : width + n] = [leaf(k) for k in range(n)]
        for at in range(width - 1, 0, -1):
            tree[at] = min(tree[2 * at], tree[2 * at + 1])

        def put(k: int, value: int) -> None:
            at = width + k
            tree[at] = value
            while at > 1:
                at >>= 1
                low = min(tree[2 * at], tree[2 * at + 1])
                if tree[at] == low:
                    return
                tree[at] = low

        while tree[1] != NONE:
            rank, k = divmod(tree[1], width)
            j = after[k]
            sym[k], sym[j] = int(made[rank]), -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            put(j, NONE)
            put(k, leaf(k))
            if before[k] >= 0:
                put(before[k], leaf(before[k]))
        return [s for s in sym if s >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where it cannot merge."""
        pair = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.order[at], NONE)

    def _encode_many(self, words: list[bytes], width: int) -> Iterator[bytes]:
        """``encode_one`` for many pre-tokens of at most ``width`` bytes, one tree each, in step."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        inside = np.arange(width) < size[:, None]
        sym = np.full((n, width + 1), -1, np.int64)  # the last column stands for no symbol
        sym[:, :width][inside] = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        after = np.where(np.arange(1, width + 2) < size[:, None], np.arange(1, width + 2), width)
        before = np.tile(np.concatenate([[width], np.arange(width)]), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int64)
        ranks = self._ranks(sym[:, : width - 1], sym[:, 1:width])
        places = np.arange(width - 1)
        tree[:, width : 2 * width - 1] = np.where(ranks != NONE, ranks * width + places, NONE)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2

        def put(rows: np.ndarray, k: np.ndarray, value: np.ndarray) -> None:
            at = width + k
            tree[rows, at] = value
            while width > 1 and at[0] > 1:
                at = at >> 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            rank, k = np.divmod(tree[rows, 1], width)
            j = after[rows, k]
            far = after[rows, j]
            sym[rows, k], sym[rows, j] = self.made[rank], -1
            after[rows, k] = far
            before[rows, far] = k
            put(rows, j, np.full(len(rows), NONE))
            right = self._ranks(sym[rows, k], sym[rows, far])
            put(rows, k, np.where(right != NONE, right * width + k, NONE))
            near = before[rows, k]
            some = np.flatnonzero(near < width)
            if len(some):
                own, p = rows[some], near[some]
                left = self._ranks(sym[own, p], sym[own, k[some]])
                put(own, p, np.where(left != NONE, left * width + p, NONE))
            rows = rows[tree[rows, 1] != NONE]
        alive = sym[:, :width] >= 0
        ends = 4 * np.cumsum(alive.sum(1))
        packed = sym[:, :width][alive].astype("<u4").tobytes()
        begin = 0
        for end in ends.tolist():
            yield packed[begin:end]
            begin = end

    # --- decoding ---------------------------------------------------------------

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(2)
def shared(raw: bytes) -> Bpe:
    """One instance, and so one cache, in each worker."""
    return Bpe(raw)


def encode(
    docs: DataFrame, path: str, text_col: str = "text", ids: str = "ids", packed: bool = False, decoded: str | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` and ``ids``: array<int>, or their little-endian bytes if ``packed``.

    With a name for ``decoded`` the ids are decoded again in the same pass, as by ``decode``.

    As the tokenizers library with the file at ``path`` and no added special
    tokens: strings of special tokens inside a text become their ids. A text is
    split into pre-tokens; each distinct one is encoded by a segment tree over the
    ranks of its adjacent pairs, whose root is the leftmost pair of lowest rank: a
    merge updates three leaves, until no pair can merge. Workers remember a bounded
    number of pre-tokens. Null and empty texts give no ids. Columns called ``ids`` or
    ``decoded`` are replaced. No shuffle; a long text needs its own ids in memory only.
    """
    new = [ids, decoded] if decoded else [ids]
    kept = [c for c in docs.columns if c not in new]
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = shared(source.value)
        rows = bpe.encode_batch([t or "" for t in batch.column(text_col).to_pylist()])
        back = [pa.array([bpe.decode(np.frombuffer(r, "<u4").tolist()) for r in rows], pa.string())] if decoded else []
        coded = pa.array(rows, pa.binary())
        if not packed:
            _, offsets, data = coded.buffers()
            ends = np.frombuffer(offsets, "<i4", len(coded) + 1)
            flat = pa.array(np.frombuffer(data, "<i4") if data is not None and data.size else np.zeros(0, np.int32))
            coded = pa.ListArray.from_arrays(pa.array(ends // 4, pa.int32()), flat.slice(0, ends[-1] // 4))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), coded, *back], [*kept, *new])

    more = f"`{ids}` {'binary' if packed else 'array<int>'}" + (f", `{decoded}` string" if decoded else "")
    return map_batches(docs, run, plus(docs, kept, more), text_col)


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows and columns of ``docs`` and ``text``, decoded from ``ids`` (array<int> or packed); null from null.

    Special tokens are written out; bytes that are no UTF-8 become U+FFFD.
    """
    kept = [c for c in docs.columns if c != text]
    packed = docs.schema[ids].dataType.simpleString() == "binary"
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, column = shared(source.value), batch.column(ids)
        rows = (np.frombuffer(x.as_buffer(), "<u4").tolist() if packed and x.is_valid else x.as_py() for x in column)
        out = pa.array([None if r is None else bpe.decode(r) for r in rows], pa.string())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), out], [*kept, text])

    return map_batches(docs, run, plus(docs, kept, f"`{text}` string"))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of each row; the digest of ``encode`` and ``decode``."""
    return encode(docs.select(id_col, text_col), path, text_col, "__ids", packed=True, decoded="__decoded").select(
        id_col,
        (F.octet_length("__ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("__ids", 256).alias("ids_sha256"),
        F.sha2("__decoded", 256).alias("decoded_sha256"),
    )
