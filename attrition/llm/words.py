"""Words of Arrow text columns as numpy arrays.

Text is never turned into Python strings: a column's UTF-8 buffer is split and
hashed with whole-array numpy operations.  A word's hash is a polynomial over
random 64-bit byte keys (prefix sums, so any length costs the same), finished
with a bit mixer; hashes of word sequences are built the same way from the
word hashes.  Hashes are stable across processes and runs.
"""

from __future__ import annotations

import ctypes
import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19       # a byte of text takes about 40 bytes while it is hashed
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_BYTE_MUL = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
_WORD_MUL = 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants); new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(mul: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``mul**i`` and ``mul**-i`` modulo 2**64 for i < n (kept per process)."""
    have = _powers.get(mul)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for m in (mul, pow(mul, -1, 1 << 64)):
            p = np.full(size, m, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 4 << 20:
            _powers[mul] = have
    return have


def give_back() -> None:
    """Drop the power tables and return freed memory to the system, at a task's
    end: Python workers live on between tasks."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def returning(run):
    """``run`` for ``mapInArrow``, giving memory back once its own variables are gone."""
    @functools.wraps(run)
    def task(batches):
        yield from run(batches)
        give_back()
    return task


def _table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], bool)


SPACE_WORD = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM_WORD = _table(lambda b: b > 0x7F or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
_KEYS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_KEYS_LOWER = _KEYS.copy()
_KEYS_LOWER[0x41:0x5B] = _KEYS[0x61:0x7B]


@dataclass
class Words:
    """Words of a list of texts: hashes, byte ranges in ``data`` and, per text,
    the range ``first[i]:first[i + 1]`` of its words."""

    data: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        n = np.diff(self.first)
        return np.repeat(self.first[1:], n) - np.arange(len(self.hash))

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def split_words(column: pa.Array, lower: bool = False, alnum: bool = False) -> Words:
    """Whitespace words ``[^\\x20\\x09-\\x0D]+`` or, with ``alnum``, runs of ASCII
    letters, digits and bytes over 0x7F.  ``lower`` folds A-Z only (in the hash)."""
    data, offsets = utf8(column)
    table, keys = (ALNUM_WORD if alnum else SPACE_WORD), (_KEYS_LOWER if lower else _KEYS)
    starts, ends, hashes = [], [], []
    lo, n_docs = 0, len(offsets) - 1
    while lo < n_docs:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, "right")) - 1)
        a, b = offsets[lo], offsets[hi]
        s, e, h = _block(data[a:b], offsets[lo:hi + 1] - a, table, keys)
        starts.append(s + a)
        ends.append(e + a)
        hashes.append(h)
        lo = hi
    cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
    start = cat(starts, np.int64)
    return Words(data, cat(hashes, np.uint64), start, cat(ends, np.int64), np.searchsorted(start, offsets))


def _block(data, offsets, table, keys):
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = table[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    up, down = powers(_BYTE_MUL, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(keys[data] * up[:n], out=total[1:])
    h = (total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)
    return start, end, mix64(h)


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range; the ranges lie one after the other."""
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + BLOCK_BYTES, "right")))
        a, b = start[lo], end[hi - 1]
        up, down = powers(_BYTE_MUL, b - a)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_KEYS[data[a:b]] * up[:b - a], out=total[1:])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        out[lo:hi] = mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def sequence_hash(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``width`` consecutive words (also across texts: mask with
    ``Words.left() >= width``); element i starts at word i."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    mul = (_WORD_MUL + 2 * seed * 0x5851F42D) & ((1 << 64) - 1) | 1
    up, down = powers(mul, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=total[1:])
    return mix64((total[width:] - total[:n + 1 - width]) * down[:n + 1 - width] + np.uint64(width + seed))


def whole_hash(hashes: np.ndarray) -> np.ndarray:
    """One-element array: the hash of the whole sequence (as ``sequence_hash``)."""
    return sequence_hash(hashes, len(hashes))
