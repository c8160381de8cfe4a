"""Words of whole texts as numpy arrays, a few megabytes of text at a time.

A word is a run of bytes outside space and 0x09-0x0D. The delimiters are ASCII,
so cutting UTF-8 bytes equals cutting code points. Words and word sequences are
identified by 64-bit hashes; two different ones share a hash with probability
2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_SEED = np.random.default_rng(20260901)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 2**64))
_STEP = _U(0xD1342543DE82EF95)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@cache
def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        both.append(np.multiply.accumulate(p))
    return both[0], both[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, kept for the usual slice length."""
    if n <= SLICE_BYTES:
        up, down = _powers_to(SLICE_BYTES)
        return up[:n], down[:n]
    return _powers_to.__wrapped__(n)


def slices(texts: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows holding at most ``most`` bytes, or one longer text; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def runs(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of one nonzero kind, never across rows."""
    n = len(kind)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[0] = cut[n] = True
    cut[1:n] |= kind[1:] != kind[:-1]
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    keep = kind[starts] != 0
    return starts[keep], ends[keep]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, by differences of one running polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def row_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row each position lies in."""
    return np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, and where each row's words begin; the words' start bytes last."""
    starts, ends = runs((~SPACE[data]).astype(np.int8), offsets)
    return hashes(data, starts, ends), np.searchsorted(starts, offsets), starts


def grams(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, row ends not considered."""
    n = len(word) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = word[:n].copy()
    for k in range(1, size):
        out *= _STEP
        out += word[k:k + n]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct shingles; fewer words than ``size`` make one shingle of them all."""
    word, first, _ = words(data, offsets)
    gram = grams(word, size)
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            sets.append(np.unique(gram[a:b - size + 1]))
        elif b > a:
            sets.append(grams(word[a:b], int(b - a)) ^ _U(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
