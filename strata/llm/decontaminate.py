"""Benchmark passages in texts: SimHash fingerprints of windows as long as the items.

A window has as many words as a benchmark item, and a fingerprint of 64 bits from its word shingles, each weighing as
often as it occurs. Fingerprints are cut into blocks of bits: within the radius of an item some block differs in no more
than ``RADIUS // BLOCKS`` bits, so tables of near block values find every item within the radius. What they find is
verified by the exact weighted similarity of the shingles. Windows without a shingle of the benchmark have similarity 0
and are passed over.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from strata.llm.textblocks import Words, blocks, mix, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
SIMILARITY = 0.75
# Windows at the similarity above differ in 11 of 64 bits on average, with a deviation of about 3.5.
RADIUS, BLOCKS = 24, 8
# Items that go to the tasks in one pass over the texts; more items take more passes.
ITEMS_PER_PASS = 20_000
_FILTER_BITS = 1 << 22


class Group(NamedTuple):
    """Items of one length in words."""

    words: int
    names: np.ndarray
    prints: np.ndarray
    near: np.ndarray  # (block, value of the block, item): within reach
    shingles: list[tuple[np.ndarray, np.ndarray]]


class Index(NamedTuple):
    filters: dict[int, np.ndarray]  # by shingle size, the hashes that occur
    known: dict[int, np.ndarray]
    owners: dict[int, list[np.ndarray]]  # lengths of the items that hold each known shingle
    groups: dict[int, Group]
    kind: pa.DataType


def _runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words in one text, and its first word."""
    h, docs = words.hashes, words.docs
    if len(h) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(docs[size - 1:] == docs[:len(docs) - size + 1])
    total = np.full(len(at), size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[at + k]
    return mix(total), at


def _signs(hashes: np.ndarray) -> np.ndarray:
    """Bits of hashes as rows of -1 and 1."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _print(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of sums of signs: uint8 rows of 8 blocks."""
    return np.packbits(sums > 0, axis=1)


def _similarity(window: np.ndarray, item: tuple[np.ndarray, np.ndarray]) -> float:
    """Shared weight over whole weight of two bags of shingles."""
    own, times = np.unique(window, return_counts=True)
    hashes, counts = item
    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
    both = np.where(hashes[at] == own, np.minimum(counts[at], times), 0).sum()
    return float(both / (counts.sum() + times.sum() - both))


def build(names: list, texts: list[str], kind: pa.DataType) -> Index:
    """Index of items; an item of fewer words than a shingle is one shingle, an item without words matches nothing."""
    words = words_of(pa.array(texts, pa.large_string()), letters=True)
    lengths = np.bincount(words.docs, minlength=len(texts))
    near_value = np.array([[bin(a ^ b).count("1") <= RADIUS // BLOCKS for b in range(256)] for a in range(256)])
    known: dict[int, list] = {}
    groups = {}
    for n in np.unique(lengths[lengths > 0]):
        items = np.flatnonzero(lengths == n)
        size = min(WORDS, int(n))
        hashes, at = _runs(words, size)
        docs = words.docs[at]
        prints, bags = [], []
        for item in items:
            own = hashes[docs == item]
            prints.append(_print(_signs(own).sum(axis=0)[None])[0])
            bags.append(np.unique(own, return_counts=True))
            known.setdefault(size, []).append((bags[-1][0], int(n)))
        prints = np.stack(prints)
        groups[int(n)] = Group(int(n), np.array(names, object)[items], prints,
                               np.stack([near_value[prints[:, b]].T for b in range(BLOCKS)]), bags)
    index = Index({}, {}, {}, groups, kind)
    for size, bags in known.items():
        flat = np.concatenate([b for b, _ in bags])
        owner = np.concatenate([np.full(len(b), n) for b, n in bags])
        hashes, codes = np.unique(flat, return_inverse=True)
        order = np.argsort(codes, kind="stable")
        index.known[size] = hashes
        index.owners[size] = [np.unique(x) for x in np.split(owner[order], np.searchsorted(codes[order], np.arange(1, len(hashes))))]
        index.filters[size] = np.zeros(_FILTER_BITS, bool)
        index.filters[size][(hashes % np.uint64(_FILTER_BITS)).astype(np.int64)] = True
    return index


def _windows(words: Words, cuts: np.ndarray, anchors: np.ndarray, n: int, size: int) -> np.ndarray:
    """First words of all windows of ``n`` words that hold one of the anchors; a shorter text is one window."""
    doc = words.docs[anchors]
    low = np.maximum(cuts[doc], anchors - (n - size))
    high = np.maximum(cuts[doc], np.minimum(anchors, cuts[doc + 1] - n))
    low = np.minimum(low, high)
    change = np.zeros(len(words.docs) + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high + 1, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def _find(index: Index, column: pa.Array) -> list[tuple[int, object, float, int, int]]:
    """(text, item, similarity, first character, end) of the best window for each item found in each text."""
    words = words_of(column, letters=True)
    cuts = np.searchsorted(words.docs, np.arange(len(column) + 1))
    best: dict[tuple[int, object], tuple[float, int, int]] = {}
    for size, known in index.known.items():
        hashes, at = _runs(words, size)
        maybe = np.flatnonzero(index.filters[size][(hashes % np.uint64(_FILTER_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        hit = known[place] == hashes[maybe]
        maybe, place = maybe[hit], place[hit]
        if not len(maybe):
            continue
        lengths = [index.owners[size][p] for p in place]
        anchor = np.repeat(at[maybe], [len(x) for x in lengths])
        lengths = np.concatenate(lengths)
        row_of = np.full(len(words.docs) + 1, -1, np.int64)
        row_of[at] = np.arange(len(at))
        for n in np.unique(lengths):
            group = index.groups[int(n)]
            starts = _windows(words, cuts, anchor[lengths == n], int(n), size)
            ends = np.minimum(starts + n, cuts[words.docs[starts] + 1])
            first, last = row_of[starts], row_of[ends - size] + 1
            # Running sums of signs over the shingles of all windows, which lie in runs without gaps.
            change = np.zeros(len(at) + 1, np.int64)
            np.add.at(change, first, 1)
            np.add.at(change, last, -1)
            used = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            number = np.zeros(len(at) + 1, np.int64)
            number[used + 1] = 1
            number = np.cumsum(number)
            running = np.zeros((len(used) + 1, 64), np.int32)
            np.cumsum(_signs(hashes[used]), axis=0, out=running[1:])
            prints = _print(running[number[last]] - running[number[first]])
            near = group.near[0][prints[:, 0]]
            for b in range(1, BLOCKS):
                near = near | group.near[b][prints[:, b]]
            window, item = np.nonzero(near)
            apart = np.bitwise_count(prints[window] ^ group.prints[item]).sum(axis=1)
            for w, i in zip(window[apart <= RADIUS], item[apart <= RADIUS]):
                value = _similarity(hashes[first[w]:last[w]], group.shingles[i])
                if value >= SIMILARITY:
                    key = (int(words.docs[starts[w]]), group.names[i])
                    found = (value, -int(starts[w]), int(ends[w]))
                    best[key] = max(best.get(key, found), found)
    chars = None
    out = []
    for (doc, name), (value, start, end) in sorted(best.items(), key=lambda x: (x[0][0], -x[1][0], str(x[0][1]))):
        if chars is None:
            chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
        base = chars[words.offsets[doc]]
        out.append((doc, name, value, int(chars[words.starts[-start]] - base), int(chars[words.ends[end - 1]] - base)))
    return out


def _lists(index: Index, column: pa.Array) -> pa.Array:
    rows = _find(index, column)
    fields = [pa.array([r[1] for r in rows], index.kind), pa.array([r[2] for r in rows], pa.float64()),
              pa.array([r[3] for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.int32())]
    cuts = np.searchsorted(np.array([r[0] for r in rows], np.int64), np.arange(len(column) + 1))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
        fields, ["item", "similarity", "start", "end"]))


def _looker(index: Index) -> Callable:
    def look(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            parts = [_lists(index, p.column("text")) for p in blocks(batch, "text")]
            yield pa.concat_arrays(parts or [_lists(index, column)])

    look.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return look


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", out_col: str = "leaks") -> DataFrame:
    """All rows plus ``out_col``: an array of ``item, similarity, start, end`` (characters), one for each item found.

    Words are runs of letters and digits in lower case. Texts are searched whole; a text of fewer words than an item is
    one window. NULL and empty texts, and items that are NULL or without words, match nothing. Items with a repeated id
    are found under it once, at the best window. ``out_col`` replaces a column of that name; an empty table of items
    finds nothing. The texts are never shuffled; items go to all tasks, ``ITEMS_PER_PASS`` at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    kind = items.schema["item"].dataType
    # All texts of an id go to one pass, so that it is found once however many passes there are.
    passes = max(1, -(-items.count() // ITEMS_PER_PASS))
    name = kind.simpleString()
    found = F.array().cast(f"array<struct<item:{name},similarity:double,start:int,end:int>>")
    for turn in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == turn).orderBy("item", "text").toPandas()
        index = build(list(rows["item"]), list(rows["text"]), to_arrow_type(kind))

        kind_of = f"array<struct<item:{name},similarity:double,start:int,end:int>>"
        # Not deterministic, so that the optimizer never evaluates it twice.
        said = F.arrow_udf(_looker(index), kind_of).asNondeterministic()(text_col)
        found = said if passes == 1 else F.concat(found, said)
    return docs.withColumn(out_col, found)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows in which no item of the benchmark is found, with all their columns."""
    return find(docs, benchmark, text_col, item_col, out_col="_leaks").where(F.size("_leaks") == 0).drop("_leaks")
