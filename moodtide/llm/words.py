"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """starts, ends: byte ranges; doc: row of each word; first: word index at which each row begins (n + 1)."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, U64)
        n = len(self.raw)
        total = np.zeros(n + 1, U64)
        np.cumsum((self.raw.astype(U64) + U64(1)) * powers(n, BASE), out=total[1:])
        return mixed((total[self.ends] - total[self.starts]) * powers(n, BASE_INVERSE)[self.starts])


def find(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> Words:
    """Runs of bytes for which ``separator`` (a table of 256 flags) is false; none crosses a row's end."""
    inside = ~separator[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(raw)]
    begins[cuts] |= inside[cuts]
    stops = np.zeros(len(raw) + 1, bool)
    stops[1:] = inside
    stops[1:-1] &= ~inside[1:]
    own = cuts[cuts > 0]
    stops[own] |= inside[own - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    first = np.searchsorted(starts, offsets)
    return Words(raw, starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def white_space() -> np.ndarray:
    """Separators of the word class [^\\x20\\x09-\\x0D]+."""
    flags = np.zeros(256, bool)
    flags[[0x20, *range(0x09, 0x0E)]] = True
    return flags


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` neighbouring word hashes; rows are not looked at."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(words) - n + 1, U64)
    for k in range(n):
        out = out * U64(BASE) + words[k : k + len(out)]
    return mixed(out)
