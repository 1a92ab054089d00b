"""CRC-32 of words and of runs of words, many at once."""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

U32 = np.uint32
POLYNOMIAL = 0xEDB88320
SHORT = 64  # longer words are hashed one by one


@cache
def byte_table() -> np.ndarray:
    """What one byte does to the register."""
    c = np.arange(256, dtype=U32)
    for _ in range(8):
        c = np.where(c & U32(1), (c >> U32(1)) ^ U32(POLYNOMIAL), c >> U32(1))
    return c


def _step(c: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return byte_table()[(c ^ byte) & U32(255)] ^ (c >> U32(8))


def _tables(columns: np.ndarray) -> np.ndarray:
    """(4, 256) lookups of the linear map that takes bit i to ``columns[i]``."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    parts = np.where(bits[None].astype(bool), columns.reshape(4, 1, 8), U32(0))
    return np.bitwise_xor.reduce(parts, axis=2).astype(U32)


def _apply(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = tables[0][c & U32(255)]
    for k in range(1, 4):
        out = out ^ tables[k][(c >> U32(8 * k)) & U32(255)]
    return out


@cache
def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """Lookups of appending 0 .. SHORT - 1 zero bytes, and SHORT * 2**k of them."""
    columns = U32(1) << np.arange(32, dtype=U32)
    few = []
    for _ in range(SHORT):
        few.append(_tables(columns))
        columns = _step(columns, 0)
    many = [_tables(columns)]
    for _ in range(26):
        columns = _apply(many[-1], columns)
        many.append(_tables(columns))
    return np.stack(few), many


def shifted(c: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The registers after as many zero bytes as ``lengths`` says."""
    few, many = _shifts()
    low = lengths % SHORT
    out = few[low, 0, c & U32(255)]
    for k in range(1, 4):
        out = out ^ few[low, k, (c >> U32(8 * k)) & U32(255)]
    high = lengths // SHORT
    for k in range(int(high.max(initial=0)).bit_length()):
        at = np.flatnonzero(high >> k & 1)
        out[at] = _apply(many[k], out[at])
    return out


def joined(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC of two strings with one blank between, from the CRC of each and the bytes of the second."""
    blank = ~_step(~first, 0x20)
    return shifted(blank, lengths) ^ second


def word_crcs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each range of bytes."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    long = int(np.searchsorted(-lengths[order], -SHORT, side="left"))
    out = np.empty(len(starts), U32)
    for k in order[:long]:
        out[k] = zlib.crc32(raw[starts[k] : ends[k]].tobytes())
    rest = order[long:]
    size, at = lengths[rest], starts[rest]
    c = np.full(len(rest), 0xFFFFFFFF, U32)
    for j in range(int(size.max(initial=0))):
        m = int(np.searchsorted(-size, -j, side="left"))
        c[:m] = _step(c[:m], raw[at[:m] + j])
    out[rest] = ~c
    return out
