"""Vectorised text helpers used inside tasks.

All helpers work on the raw UTF-8 bytes of an Arrow string array, so a batch of
texts is tokenised by a handful of numpy passes and no Python string is made
per word.  A word is a maximal run of bytes other than 0x20 and 0x09-0x0D
(``[^\\x20\\x09-\\x0D]+``); only the ASCII letters A-Z are lower-cased.
"""

from __future__ import annotations

import ctypes
import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_B = U64(0x9E3779B97F4A7C15 | 1)
_B_INV = U64(pow(int(_B), -1, 1 << 64))


def splitmix(x) -> np.ndarray:
    """The splitmix64 finaliser: a bijective mix of 64-bit integers."""
    x = np.asarray(x, dtype=U64)
    with np.errstate(over="ignore"):
        x = x + U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_BYTE_CODE = splitmix(np.arange(256, dtype=U64) + U64(0xA5A5))
_POW: dict[str, np.ndarray] = {"b": np.ones(1, U64), "i": np.ones(1, U64)}


def _powers(kind: str, base, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    if len(_POW[kind]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        p = np.full(size, base, U64)
        p[0] = 1
        with np.errstate(over="ignore"):
            _POW[kind] = np.cumprod(p, dtype=U64)
    return _POW[kind][:n]


def returning_memory(run):
    """``run`` (batches to batches) that gives freed memory back to the system when it ends: Spark
    keeps its Python workers, and what one stage's arrays took would count on into the next."""

    @functools.wraps(run)
    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
            trim(0)

    return tidy


def string_column(col) -> pa.StringArray:
    """An Arrow string column as one array without nulls (null becomes empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = pc.fill_null(col, "")
    return col


def raw(col: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; offsets start at 0."""
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    off = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(col: pa.StringArray, max_bytes: int = SLICE_BYTES):
    """Row ranges [a, b) whose texts hold about ``max_bytes`` (always whole
    texts: a longer text makes a range of its own)."""
    n = len(col)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    off = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + max_bytes, "right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


@dataclass
class Words:
    """Words of a run of texts: byte ranges, hashes, and the words' range per text."""

    buf: np.ndarray       # lower-cased bytes
    off: np.ndarray       # byte offsets of the texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray     # word offsets of the texts (length: texts + 1)
    hash: np.ndarray      # 64-bit hash of each word


def lower_bytes(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def words(col: pa.StringArray, lower: bool = True) -> Words:
    """Split the texts of a null-free string array into words and hash each."""
    buf, off = raw(col)
    if lower:
        buf = _LOWER[buf]
    n = len(buf)
    inside = ~_SPACE[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, off)
    return Words(buf, off, start, end, first, range_hashes(buf, start, end))


def range_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range [start, end)."""
    n = len(buf)
    with np.errstate(over="ignore"):
        acc = np.zeros(n + 1, U64)
        np.cumsum(_BYTE_CODE[buf] * _powers("b", _B, n), dtype=U64, out=acc[1:])
        h = (acc[end] - acc[start]) * _powers("i", _B_INV, n + 1)[start]
        return splitmix(h ^ ((end - start).astype(U64) << U64(48)))


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and their offsets per text.  A text
    with fewer words (but at least one) has its whole sequence as one shingle."""
    n_words = np.diff(w.first)
    count = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(count)])
    total = int(first[-1])
    if not total:
        return np.zeros(0, U64), first
    text = np.repeat(np.arange(len(n_words)), count)
    at = w.first[text] + (np.arange(total) - first[text])
    length = np.minimum(n_words[text], size)
    padded = np.concatenate([w.hash, np.zeros(size, U64)])
    with np.errstate(over="ignore"):
        h = length.astype(U64)
        for k in range(size):
            h = np.where(k < length, splitmix(h * _B + padded[at + k]), h)
    return h, first


class KeyIndex:
    """Positions of 64-bit keys in a sorted array of distinct keys: one probe
    into an open table; the few keys that collide there use binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = U64(64 - max(10, int(max(1, len(keys)) * 4 - 1).bit_length()))
        self.table = np.zeros(1 << int(64 - int(self.shift)), np.int32)
        self.table[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, x):
        with np.errstate(over="ignore"):
            return ((x * _B) ^ (x >> U64(29)) * U64(0xD6E8FEB86659FD93)) >> self.shift

    def find(self, x: np.ndarray, missing: bool = False) -> np.ndarray:
        """Position of each x; with ``missing``, -1 where x is not a key."""
        if not len(self.keys):
            return np.full(len(x), -1, np.int64)
        at = self.table[self._slot(x)].astype(np.int64)
        odd = np.flatnonzero(self.keys[at] != x)
        if len(odd):
            pos = np.minimum(np.searchsorted(self.keys, x[odd]), len(self.keys) - 1)
            if missing:
                pos = np.where(self.keys[pos] == x[odd], pos, -1)
            at[odd] = pos
        return at


class KeyTable:
    """Position of 64-bit keys in a list, or its length: a few hash tables, each
    holding the keys that found their slot taken in the one before."""

    def __init__(self, keys: np.ndarray):
        self.n, self.levels, left, bits = len(keys), [], np.arange(len(keys)), 2 + max(8, len(keys).bit_length())
        self.keys = np.append(keys, keys[:1])
        while len(left):
            table = np.full(1 << bits, self.n, np.int32)
            slot = self._slot(keys[left], len(self.levels), bits)
            table[slot] = left
            self.levels.append((table, bits))
            left = left[table[slot] != left]
            bits = max(10, bits - 3)

    @staticmethod
    def _slot(x, level, bits):
        with np.errstate(over="ignore"):
            return (x.astype(U64) * U64(0x9E3779B97F4A7C15 + 2 * level * 0x51ED270B)) >> U64(64 - bits)

    def find(self, x: np.ndarray) -> np.ndarray:
        out, place = np.full(len(x), self.n, np.int64), None
        for level, (table, bits) in enumerate(self.levels):
            at = table[self._slot(x, level, bits)]
            same = self.keys[at] == x
            taken = at < self.n
            hit = np.flatnonzero(same & taken)
            out[hit if place is None else place[hit]] = at[hit]
            # only a key that found its slot taken by another one lies further down
            rest = np.flatnonzero(taken & ~same)
            if not len(rest):
                break
            x, place = x[rest], rest if place is None else place[rest]
        return out


def sorted_distinct(x: np.ndarray) -> np.ndarray:
    """Distinct values in order (a plain sort is several times faster than argsort)."""
    if not len(x):
        return x
    s = np.sort(x)
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def sum_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values (an empty range sums to 0)."""
    acc = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return acc[first[1:]] - acc[first[:-1]]
