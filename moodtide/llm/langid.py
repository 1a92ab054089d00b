"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from moodtide.llm.frames import columns, map_batches, plus, text_buffers

UNKNOWN = "und"
SAMPLE_DOCS = 300  # texts of each language that the network learns from, at most
SAMPLE_CHARS = 1024  # characters taken from each, at a hashed place
LANGUAGES = 500  # distinct values of lang, at most: each sends its pieces to the driver
HIDDEN = 8
BLOCK = 256  # bytes after which the state starts anew when texts are labelled
SIDE_BY_SIDE = 2048  # blocks worked on in one step
PAD = 256  # stands for no byte; its input to the candidate state is fixed at zero, so a zero state stays zero


def softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Network:
    """Gates and candidate use softsign for tanh, which costs a third of the time.

    table: (2, 3H, 257) input of each byte to update gate, reset gate, candidate;
    inner: (2, 3H, H); outer: (2, L, H); bias: (L,). The first axis is the direction.
    """

    labels: list[str]
    table: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, labels: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.5, (2, 3 * hidden, PAD + 1))
        table[:, 2 * hidden :, PAD] = 0
        inner = rng.normal(0, hidden**-0.5, (2, 3 * hidden, hidden))
        outer = rng.normal(0, hidden**-0.5, (2, len(labels), hidden))
        return cls(labels, table, inner, outer, np.zeros(len(labels)))

    def weights(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.outer, self.bias]

    def forward(self, data: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """Logits (T, L, B) of a block of bytes (T, B), and what ``gradient`` needs."""
        steps, width = data.shape
        hidden = self.inner.shape[2]
        both = np.stack([data, data[::-1]])
        h = np.zeros((2, hidden, width))
        seen, out = [], np.empty((2, steps, len(self.labels), width))
        for t in range(steps):
            x = np.stack([self.table[d][:, both[d, t]] for d in range(2)])
            g = self.inner @ h
            gates = 0.5 + 0.5 * softsign(x[:, : 2 * hidden] + g[:, : 2 * hidden])
            z, r, inside = gates[:, :hidden], gates[:, hidden:], g[:, 2 * hidden :]
            n = softsign(x[:, 2 * hidden :] + r * inside)
            seen.append((h, z, r, n, inside))
            h = n + z * (h - n)
            out[:, t] = self.outer @ h
            seen[-1] += (h,)
        return out[0] + out[1][::-1] + self.bias[:, None], seen

    def gradient(self, data: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss at every position that is no padding and its gradient, by backpropagation through time."""
        steps, width = data.shape
        hidden = self.inner.shape[2]
        logits, seen = self.forward(data)
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        real = (data != PAD)[:, None, :]
        n_real = max(real.sum(), 1)
        at = np.arange(width)
        loss = -(np.log(p[:, target, at] + 1e-30) * real[:, 0]).sum() / n_real
        p[:, target, at] -= 1
        d_logits = p * real / n_real
        both = np.stack([data, data[::-1]])
        d_both = np.stack([d_logits, d_logits[::-1]])
        d_table, d_inner, d_outer = (np.zeros_like(w) for w in self.weights()[:3])
        d_h = np.zeros((2, hidden, width))
        d_inputs = np.empty((steps, 2, 3 * hidden, width))
        slope = lambda s: (1 - np.abs(s)) ** 2
        for t in range(steps - 1, -1, -1):
            before, z, r, n, inside, h = seen[t]
            d_outer += d_both[:, t] @ h.transpose(0, 2, 1)
            d_h = d_h + self.outer.transpose(0, 2, 1) @ d_both[:, t]
            d_n = d_h * (1 - z) * slope(n)
            d_z = d_h * (before - n) * 0.5 * slope(2 * z - 1)
            d_r = d_n * inside * 0.5 * slope(2 * r - 1)
            d_inputs[t] = np.concatenate([d_z, d_r, d_n], 1)
            d_g = np.concatenate([d_z, d_r, d_n * r], 1)
            d_inner += d_g @ before.transpose(0, 2, 1)
            d_h = d_h * z + self.inner.transpose(0, 2, 1) @ d_g
        for d in range(2):
            flat = np.zeros((PAD + 1, 3 * hidden))
            np.add.at(flat, both[d].ravel(), d_inputs[:, d].transpose(0, 2, 1).reshape(-1, 3 * hidden))
            d_table[d] = flat.T
        d_table[:, 2 * hidden :, PAD] = 0
        return loss, [d_table, d_inner, d_outer, d_logits.sum((0, 2))]

    def compact(self) -> Network:
        """Weights as contiguous 32-bit floats, for ``probabilities``."""
        return Network(self.labels, *(np.ascontiguousarray(w, np.float32) for w in self.weights()))

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """Probability of each label at each position: (T, L, B). As ``forward``, in place."""
        steps, width = data.shape
        hidden, one, half = self.inner.shape[2], np.float32(1), np.float32(0.5)
        both = np.stack([data, data[::-1]], 1)
        h = np.zeros((2, hidden, width), np.float32)
        x, g = (np.empty((2, 3 * hidden, width), np.float32) for _ in range(2))
        size, less = np.empty((2, 2 * hidden, width), np.float32), np.empty((2, hidden, width), np.float32)
        out = np.empty((steps, 2, len(self.labels), width), np.float32)
        for t in range(steps):
            for d in range(2):
                np.take(self.table[d], both[t, d], axis=1, out=x[d], mode="clip")
            np.matmul(self.inner, h, out=g)
            gates = x[:, : 2 * hidden]
            gates += g[:, : 2 * hidden]
            np.abs(gates, out=size)
            size += one
            gates /= size
            gates *= half
            gates += half
            n = g[:, 2 * hidden :]
            n *= gates[:, hidden:]
            n += x[:, 2 * hidden :]
            np.abs(n, out=less)
            less += one
            n /= less
            h -= n
            h *= gates[:, :hidden]
            h += n
            np.matmul(self.outer, h, out=out[t])
        logits = out[:, 0] + out[::-1, 1]
        logits += self.bias[:, None]
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits


def train(
    texts: list[bytes], targets: list[str], hidden: int = HIDDEN, rounds: int = 300, batch: int = 96, span: int = 64, seed: int = 7,
) -> Network | None:
    """A network fitted to (text, label) pairs by Adam; None without pairs. Deterministic."""
    labels = sorted(set(targets))
    if not labels:
        return None
    net = Network.fresh(labels, hidden, seed)
    rng = np.random.default_rng(seed)
    rows = [[np.frombuffer(t, np.uint8) for t, y in zip(texts, targets) if y == label and t] for label in labels]
    known = [k for k, own in enumerate(rows) if own]
    first, second = ([np.zeros_like(w) for w in net.weights()] for _ in range(2))
    for turn in range(1, rounds + 1 if known else 1):
        data = np.full((span, batch), PAD)
        target = np.empty(batch, np.int64)
        for k in range(batch):
            target[k] = known[k % len(known)]
            own = rows[target[k]]
            text = own[rng.integers(len(own))]
            at = rng.integers(max(len(text) - span, 0) + 1)
            piece = text[at : at + span]
            data[: len(piece), k] = piece
        _, grads = net.gradient(data, target)
        norm = np.sqrt(sum((g**2).sum() for g in grads))
        rate = 0.02 * min(1, 2 * (1 - turn / (rounds + 1)))
        for w, g, m, v in zip(net.weights(), grads, first, second):
            g = g / max(1, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g**2 - v)
            w -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return net


def held_out(id_col: str) -> Column:
    """The rows that nothing is learned from: crc32 of the id's digits modulo 4 is 2. Not so for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def sample(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, n_docs: int = SAMPLE_DOCS, n_chars: int = SAMPLE_CHARS
) -> tuple[list[bytes], list[str]]:
    """Pieces of at most ``n_docs`` texts of each language, by least hash of the id: what the driver holds is bounded.

    More than LANGUAGES values of lang are an error: such a column names something else.

    A hash threshold taken from the counts of the rows that may be learned from
    leaves about four times as many of them as wanted, so a language with most of all rows sends no more than a rare one.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), has_letter(text_col).alias("ok")
    )
    rows = rows.where("ok").withColumn("hash", F.xxhash64("id", F.lit(11)))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} values of {lang_col}")
    if not counts:
        return [], []
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4 * n_docs / n))))
    few = rows.where((F.col("hash") / 2.0**64 + 0.5) <= share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("hash", "id", "text")
    place = (F.pmod(F.xxhash64("id", F.lit(12)), F.greatest(F.length("text") - n_chars, F.lit(0)) + 1) + 1).cast("int")
    chosen = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= n_docs)
    pieces = chosen.select("lang", "k", F.substring("text", place, F.lit(n_chars)).alias("piece"))
    got = sorted((r["lang"], r["k"], r["piece"]) for r in pieces.collect())
    return [p.encode() for _, _, p in got], [lang for lang, _, _ in got]


def _pooled(net: Network, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of position probabilities, and positions labelled with each language, for each text."""
    size = np.diff(offsets)
    blocks = -(-size // BLOCK)
    owner = np.repeat(np.arange(len(size)), blocks)
    begin = offsets[:-1][owner] + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    length = np.minimum(offsets[1:][owner] - begin, BLOCK)
    total = np.zeros((len(size), len(net.labels)))
    count = np.zeros((len(size), len(net.labels)), np.int64)
    order = np.argsort(length, kind="stable")  # short blocks together, so that little is padded
    width = int(np.clip(4 * SIDE_BY_SIDE // len(net.labels), 16, SIDE_BY_SIDE))
    for k in range(0, len(order), width):
        part = order[k : k + width]
        steps = int(length[part[-1]])
        grid = np.arange(steps)[:, None]
        real = grid < length[part]
        data = np.where(real, raw[np.minimum(begin[part] + grid, len(raw) - 1)].astype(np.int32), PAD)
        p = net.probabilities(data)
        best = p.argmax(1)
        p *= real[:, None, :]
        np.add.at(total, owner[part], p.sum(0).T)
        np.add.at(count, owner[part], np.stack([((best == j) & real).sum(0) for j in range(len(net.labels))], 1))
    return total, count


NAMES = ("lang_pred", "score", "n_positions")


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", names: tuple[str, str, str] = NAMES) -> DataFrame:
    """All rows and columns of ``docs``, lang_pred (string), score (double), n_positions (array<bigint>), or so under ``names``.

    The network labels every byte of the whole text, in blocks of BLOCK bytes;
    score is the mean over all positions of the probability of the language that
    has most, and n_positions counts the positions labelled with each of the
    network's labels in their order. A text that is null or has no letter, and any
    text if nothing was learned, is ``und`` with score 0 and null n_positions.
    Columns with those names are replaced. No shuffle.
    """
    new = list(names)
    kept = [c for c in docs.columns if c not in new]
    small = net.compact() if net else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lettered = batch.column(len(kept))
        langs, scores, counts = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows, [None] * batch.num_rows
        at = np.flatnonzero(lettered.to_numpy(zero_copy_only=False))
        if small and len(at):
            raw, offsets = text_buffers(batch.column(text_col).take(pa.array(at)))
            total, count = _pooled(small, raw, offsets)
            mean = total / np.diff(offsets)[:, None]
            for k, j, m, n in zip(at.tolist(), mean.argmax(1).tolist(), mean.max(1).tolist(), count.tolist()):
                langs[k], scores[k], counts[k] = small.labels[j], min(max(m, 0.0), 1.0), n
        columns = [pa.array(langs), pa.array(scores), pa.array(counts, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], [*kept, *new])

    free = next(n for k in range(len(kept) + 1) if (n := f"letters_{k}") not in kept)
    source = docs.select(*columns(kept), has_letter(text_col).alias(free))
    return map_batches(source, run, plus(docs, kept, f"`{new[0]}` string, `{new[1]}` double, `{new[2]}` array<bigint>"), text_col)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """The network fitted to the bounded sample of ``docs``; rows that are held out take no part."""
    return train(*sample(docs, id_col, text_col, lang_col))
