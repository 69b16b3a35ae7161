"""Numpy helpers over Arrow string columns: words, word hashes and word n-grams.

All functions work on a whole Arrow column at once.  Texts are processed in
chunks of about ``CHUNK`` bytes, so the temporary arrays stay bounded by the
chunk or by the longest single text.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
#: Word separators: space and \x09-\x0D.
SEPARATORS = b" \t\n\x0b\x0c\r"

IS_SEP = np.zeros(256, bool)
IS_SEP[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 3
_STEP = [np.uint64(x | 1) for x in _rng.integers(1, 2**63, 64, dtype=np.uint64).tolist()]
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (grown on demand, kept per process)."""
    global _pow, _inv
    if len(_pow) < n:
        n = max(n, CHUNK + 1)
        for name, base in (("_pow", _BASE), ("_inv", pow(_BASE, -1, 2**64))):
            steps = np.full(n, np.uint64(base), np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, off


def chunks(col: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of texts of about ``limit`` bytes."""
    data, off = byte_view(col)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


@functools.cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library: nothing to call
        return lambda _: 0


def release_memory() -> None:
    """Give freed memory back.  Spark keeps Python workers for the next task, and each would hold the
    most that any of its tasks needed."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def frugal(run):
    """A batch function that releases its memory when its task ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return wrapped


@dataclass
class Words:
    """Words of a run of texts: text index, byte range and 64-bit hash of each."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # first word of each text; one more entry closes the last text

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``k`` words inside one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h += self.hash[j:j + n] * _STEP[j]
        return at, mix(h[at])


def words(data: np.ndarray, off: np.ndarray, separators: np.ndarray = IS_SEP) -> Words:
    """Maximal runs of bytes that are no separators (``[^\\x20\\x09-\\x0D]+``, unless others are given)
    in the texts ``data[off[i]:off[i + 1]]``."""
    n = len(data)
    token = np.zeros(n + 1, bool)
    token[:n] = ~separators[data]
    before = np.zeros(n + 1, bool)
    before[1:] = token[:n]
    before[off[:-1]] = False  # a text starts anew
    start = np.flatnonzero(token & ~before)
    after = np.zeros(n + 1, bool)
    after[:n] = token[1:]
    edges = off[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(token & ~after) + 1
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start])
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    return Words(doc, start, end, h, first)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return LOWER[data]


def char_count(data: np.ndarray) -> np.ndarray:
    """Running count of code points: entry i counts those that start before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    n = len(data)
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])
