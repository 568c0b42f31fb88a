"""Words and shingles of whole text columns with NumPy, straight from Arrow's UTF-8 buffers.

A block is a run of whole texts; a text is never cut. Words are identified by 64-bit hashes: two different words of a
corpus share one with a chance of about n * n / 2**65.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks receive these functions by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts are worked on in blocks of about so many bytes, so that the arrays of a block stay near the processor's cache.
BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict = {}


class Words(NamedTuple):
    """The words of a block in order. ``starts`` and ``ends`` are byte places in ``data``."""

    hashes: np.ndarray
    docs: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def _powers(n: int, base: int) -> np.ndarray:
    have = _tables.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        _tables[base] = have = np.multiply.accumulate(out)
    return have[:n]


def _classes(letters: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words, and the value of each byte with A-Z in lower case."""
    if letters not in _tables:
        lower = np.arange(256)
        lower[65:91] += 32
        if letters:
            inside = np.zeros(256, bool)
            inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
        else:
            inside = np.ones(256, bool)
            inside[[9, 10, 11, 12, 13, 32]] = False
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[lower]
        _tables[letters] = (inside, values)
    return _tables[letters]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a permutation, so different values stay different)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column and the offsets of its texts; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    if body is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system: Python workers stay, and what they keep counts against their executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def blocks(batch: pa.RecordBatch, text_col: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows with about ``size`` bytes of text each."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths.astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
    release()


def words_of(column: pa.Array, letters: bool = False) -> Words:
    """Words in lower case: runs of bytes that are no white space, with A-Z lowered, or with ``letters`` runs of letters
    and digits, with the accented capitals of Latin-1 lowered too."""
    data, offsets = texts_of(column)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none, data, offsets)
    table, values = _classes(letters)
    inside = table[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    # A word's hash is a polynomial of its bytes, taken from running sums over the block.
    if letters:
        folded = data.copy()
        accents = np.flatnonzero(data[:-1] == 0xC3) + 1
        capital = accents[(data[accents] >= 0x80) & (data[accents] <= 0x9E) & (data[accents] != 0x97)]
        folded[capital] += 0x20
        data = folded
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * _powers(n, _BASE), out=running[1:])
    hashes = (running[ends] - running[starts]) * _powers(n, _INVERSE)[starts]
    docs = np.searchsorted(offsets, starts, "right") - 1
    return Words(mix(hashes + (ends - starts).astype(np.uint64)), docs, starts, ends, data, offsets)


def shingles_of(words: Words, n_docs: int, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of every run of ``size`` words; a shorter text that has words is one run as a whole."""
    h, docs = words.hashes, words.docs
    if not len(h):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    weights = [np.uint64(pow(_INVERSE, k + 3, 1 << 64)) for k in range(size)]
    counts = np.bincount(docs, minlength=n_docs)
    at = np.flatnonzero(docs[size - 1:] == docs[:len(docs) - size + 1]) if len(h) >= size else np.zeros(0, np.int64)
    full = np.zeros(len(at), np.uint64)
    for k in range(size):
        full += h[at + k] * weights[k]
    short = np.flatnonzero((counts > 0) & (counts < size))
    begin = np.searchsorted(docs, short)
    part = counts[short].astype(np.uint64)
    for k in range(size - 1):
        has = counts[short] > k
        part[has] += h[begin[has] + k] * weights[k]
    starts = np.concatenate([at, begin])
    order = np.argsort(starts, kind="stable")
    return (mix(np.concatenate([full, part]))[order], np.concatenate([docs[at], short])[order], starts[order])


def distinct_per_text(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs sorted by both, and how often each occurs."""
    order = np.lexsort((hashes, docs))
    h, d = hashes[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return h[at], d[at], np.diff(np.append(at, len(h)))
