"""Language-model scores of whole texts from a log-frequency Bloom filter of word pairs.

A pair counted ``c`` times is in the filter once for each step of its quantised count ``1 + floor(log2 c)``; how many
steps are found says how often the pair occurs, and stands for the mean of the counts quantised alike. The filter grows
with the corpus, so it can't go to all workers: it is cut into segments by the pairs' hashes, built from the texts to
learn from and stored. To score, each block of texts probes the segments for its pairs: probes meet their segment by an
equality join, and the filter is all that is known of pairs. Counts of single words are exact and lie with the segments.
Texts are read in blocks of whole rows; what is shuffled are the distinct words and pairs of a block, so that a frequent
word is one entry per block.

Words are runs of bytes that are not white space, A-Z in lower case, and each text has one end more. A token after the
context ``u`` has the chance ``(c(u,w) + T(u) P(w)) / (c(u) + T(u))``, where ``P(w)`` is the add-one chance of the word
and ``T(u) = c(u) ** g`` stands for the different words seen after ``u``; ``g`` is chosen so that all ``T`` add up to
the number of different pairs. As the counts of the steps are means, the chances after a context add up to one on average,
not for each context, but for what the filter finds falsely.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.storage import stored
from strata.llm.textblocks import blocks, mix, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 4 << 20
# Bits of the filter for each entry, and probes of each entry: about one probe in 300 finds what isn't there.
BITS_PER_ENTRY, PROBES = 12, 8
_PAIR_BITS = 40
# Steps that counts can take: a count is below 2 ** 47, and a false step may follow the last.
_STEPS = 64
_POWERS = np.round(np.arange(0.0, 1.001, 0.02), 2)
_END, _START = np.uint64(0x5DEECE66D1234567), np.uint64(0x2545F4914F6CDD1D)


class Totals(NamedTuple):
    tokens: int
    words: int
    power: float
    counts: np.ndarray  # the count that each number of steps stands for


def _steps_of(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, 1 + np.floor(np.log2(np.maximum(counts, 1))), 0).astype(np.int64)


def build_filter(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits that hold the quantised counts of pairs."""
    steps = _steps_of(counts)
    bits = np.zeros(max(64, BITS_PER_ENTRY * int(steps.sum())), bool)
    for step in range(1, int(steps.max(initial=0)) + 1):
        for at in _places(hashes[steps >= step], step, len(bits)):
            bits[at] = True
    return np.packbits(bits, bitorder="little")


def _places(hashes: np.ndarray, step: int, size: int) -> Iterator[np.ndarray]:
    h = mix(hashes + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    jump = mix(h + np.uint64(1)) | np.uint64(1)
    for k in range(PROBES):
        yield ((h + np.uint64(k) * jump) % np.uint64(size)).astype(np.int64)


def probe(bits: np.ndarray, size: int, hashes: np.ndarray) -> np.ndarray:
    """Steps found for each hash: probes of the next step go on until one fails."""
    steps = np.zeros(len(hashes), np.uint8)
    left = np.arange(len(hashes))
    while len(left):
        step = int(steps[left[0]]) + 1
        found = np.ones(len(left), bool)
        for at in _places(hashes[left], step, size):
            found &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        left = left[found]
        steps[left] = step
    return steps


def count_of(steps: np.ndarray) -> np.ndarray:
    """The count that a number of steps stands for where none was learnt: the middle of those quantised alike."""
    low = np.exp2(np.maximum(steps.astype(np.float64) - 1, 0))
    return np.where(steps > 0, (3 * low - 1) / 2, 0.0)


def _pack(values: np.ndarray, width: int) -> bytes:
    """Compressed unsigned numbers below 256 ** width, byte by byte of all."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _steps_up(values: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers."""
    return np.diff(values, prepend=values.dtype.type(0))


class _Block:
    """Consecutive rows as numbered words."""

    def __init__(self) -> None:
        self.keys: list = []
        self.held: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, rows: pa.RecordBatch) -> None:
        words = words_of(rows.column("text"))
        counts = np.bincount(words.docs, minlength=rows.num_rows)
        ends = np.cumsum(counts)
        self.hashes.append(np.insert(words.hashes, ends, _END))
        self.counts.append(counts + 1)
        self.keys += rows.column("key").to_pylist()
        self.held.append(rows.column("held").to_numpy(zero_copy_only=False).astype(bool))
        self.bytes += len(words.data) + 64 * rows.num_rows

    def close(self) -> None:
        """Distinct words (sorted) and the number of each token's word."""
        self.counts = np.concatenate(self.counts)
        self.held = np.concatenate(self.held)
        tokens = np.concatenate(self.hashes)
        self.words, self.codes = np.unique(tokens, return_inverse=True)
        digest = hashlib.blake2b(repr(self.keys).encode(), digest_size=16)
        for part in (tokens, self.counts, self.held):
            digest.update(np.ascontiguousarray(part).tobytes())
        self.name = digest.hexdigest()


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for batch in batches:
        for rows in blocks(batch, "text"):
            block.add(rows)
            if block.bytes >= BLOCK_BYTES:
                block.close()
                yield block
                block = _Block()
    if block.keys:
        block.close()
        yield block


def _pairs(words: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with its context, and the context's number (that behind the last word at a text's begin)."""
    context = np.empty(len(codes), np.int64)
    context[1:] = codes[:-1]
    context[np.cumsum(counts) - counts] = len(words)
    return mix(np.append(words, _START)[context] * np.uint64(0xD6E8FEB86659FD93) + words[codes]), context


def _by_shard(hashes: np.ndarray, shards: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of hashes by shard and value, where each shard begins, and the values within shards."""
    shard = (hashes >> np.uint64(_PAIR_BITS)) % np.uint64(shards)
    value = hashes & np.uint64((1 << bits) - 1)
    order = np.lexsort((value, shard))
    return order, np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64)), value[order]


def _parts(sides: list[tuple[np.ndarray, int]], shards: int) -> tuple[list[int], list[list[tuple]]]:
    """Shards that get any of the sorted-by-shard values, and for each side, per shard, values and their places."""
    cut = []
    for values, bits in sides:
        order, cuts, value = _by_shard(values, shards, bits)
        cut.append([(value[cuts[s]:cuts[s + 1]], order[cuts[s]:cuts[s + 1]]) for s in range(shards)])
    return [s for s in range(shards) if any(len(c[s][0]) for c in cut)], cut


def _taught(shards: int) -> Callable:
    """Rows (shard, words, pairs and their counts) for each block of texts to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(batches):
            hashes, _ = _pairs(block.words, block.codes, block.counts)
            pairs, pair_counts = np.unique(hashes, return_counts=True)
            times = np.bincount(block.codes, minlength=len(block.words)), pair_counts
            full, (words, found) = _parts([(block.words, 64), (pairs, _PAIR_BITS)], shards)
            columns = [pa.array(full, pa.int32())]
            for side, n, width in ((words, times[0], 8), (found, times[1], _PAIR_BITS // 8)):
                columns.append(pa.array([_pack(_steps_up(side[s][0]), width) for s in full], pa.binary()))
                columns.append(pa.array([_pack(n[side[s][1]].astype(np.uint64), 4) for s in full], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["shard", "words", "word_counts", "pairs", "pair_counts"])

    return run


def _asked(shards: int) -> Callable:
    """Rows (block, shard, words, pairs): what each block of texts asks of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(batches):
            pairs = np.unique(_pairs(block.words, block.codes, block.counts)[0])
            full, (words, found) = _parts([(block.words, 64), (pairs, _PAIR_BITS)], shards)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.name] * len(full)), pa.array(full, pa.int32()),
                 pa.array([_pack(_steps_up(words[s][0]), 8) for s in full], pa.binary()),
                 pa.array([_pack(_steps_up(found[s][0]), _PAIR_BITS // 8) for s in full], pa.binary())],
                ["block", "shard", "words", "pairs"])

    return run


def _read(rows: pa.Table, name: str, width: int) -> Iterator[np.ndarray]:
    return (_unpack(x.as_py(), width) for x in rows.column(name))


def _totals(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values (sorted) and their counts added up."""
    distinct, codes = np.unique(np.concatenate(values), return_inverse=True)
    return distinct, np.bincount(codes, np.concatenate(counts).astype(np.float64), len(distinct)).astype(np.int64)


def _segment(rows: pa.Table) -> pa.Table:
    """One segment of the model: words with their counts, the filter of its pairs, and sums over both."""
    words, word_total = _totals([np.cumsum(x, dtype=np.uint64) for x in _read(rows, "words", 8)],
                                list(_read(rows, "word_counts", 4)))
    pairs, pair_total = _totals([np.cumsum(x, dtype=np.uint64) for x in _read(rows, "pairs", _PAIR_BITS // 8)],
                                list(_read(rows, "pair_counts", 4)))
    known, steps = word_total.astype(np.float64), _steps_of(pair_total)
    sums = [known.sum(), len(known), len(pairs), *[(known ** g).sum() for g in _POWERS],
            *np.bincount(steps, minlength=_STEPS), *np.bincount(steps, pair_total, _STEPS)]
    return pa.table({
        "shard": rows.column("shard").slice(0, 1), "words": pa.array([_pack(_steps_up(words), 8)], pa.binary()),
        "word_counts": pa.array([_pack(word_total.astype(np.uint64), 6)], pa.binary()),
        "filter": pa.array([build_filter(pairs, pair_total).tobytes()], pa.binary()),
        "size": pa.array([max(64, BITS_PER_ENTRY * int(_entries(pair_total)))], pa.int64()),
        "sums": pa.array([[float(x) for x in sums]], pa.list_(pa.float64()))})


def _answer(asked: pa.Table, segment: pa.Table) -> pa.Table:
    """Counts of the words and filter steps of the pairs that each block asks a segment for; 0 where there is none."""
    counts, steps = [], []
    if segment.num_rows:
        known = np.cumsum(next(_read(segment, "words", 8)), dtype=np.uint64)
        total = next(_read(segment, "word_counts", 6))
        bits = np.frombuffer(segment.column("filter")[0].as_py(), np.uint8)
        size = segment.column("size")[0].as_py()
    for words, pairs in zip(_read(asked, "words", 8), _read(asked, "pairs", _PAIR_BITS // 8)) if asked.num_rows else ():
        words, pairs = np.cumsum(words, dtype=np.uint64), np.cumsum(pairs, dtype=np.uint64)
        if segment.num_rows and len(known):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            counts.append(_pack(np.where(known[at] == words, total[at], 0).astype(np.uint64), 6))
        else:
            counts.append(_pack(np.zeros(len(words), np.uint64), 6))
        found = probe(bits, size, pairs) if segment.num_rows else np.zeros(len(pairs), np.uint8)
        steps.append(_pack(found.astype(np.uint64), 1))
    keys = [asked.column(c) if asked.num_rows else pa.array([], k) for c, k in (("block", pa.string()), ("shard", pa.int32()))]
    return pa.table([*keys, pa.array(counts, pa.binary()), pa.array(steps, pa.binary())],
                    names=["block", "shard", "counts", "steps"])


def chances(totals: Totals, steps: np.ndarray, own: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Chance of each token by the steps found for it and its context, and by the counts of both."""
    both = np.minimum(totals.counts[steps], np.minimum(own, before))
    kinds = np.where(before > 0, before ** totals.power, 1.0)
    return (both + kinds * (own + 1) / (totals.tokens + totals.words + 1)) / (before + kinds)


def _entries(counts: np.ndarray) -> int:
    return _steps_of(counts).sum()


def _numbered(kind: pa.DataType) -> Callable:
    """Rows (block, keys, held, counts, words, codes) with the texts of each block as numbers of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each_block(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.name]), pa.array([block.keys], pa.list_(kind)), pa.array([block.held.tolist()]),
                 pa.array([_pack(block.counts.astype(np.uint64), 4)], pa.binary()),
                 pa.array([_pack(_steps_up(block.words), 8)], pa.binary()),
                 pa.array([_pack(block.codes.astype(np.uint64), 4)], pa.binary())],
                ["block", "keys", "held", "counts", "words", "codes"])

    return run


def _scores(totals: Totals, shards: int, kind: pa.DataType, names: list[str]) -> Callable:
    base_of = totals.tokens + totals.words + 1

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or not answers.num_rows:
            raise RuntimeError("the input gave other rows when it was read again; score a stored table")
        # Equal blocks share their name, and all of their answers are equal.
        order = np.unique(answers.column("shard").to_numpy(), return_index=True)[1]
        by = {c: answers.column(c).to_pylist() for c in ("counts", "steps")}
        counts = np.concatenate([_unpack(by["counts"][i], 6) for i in order]).astype(np.float64)
        steps = np.concatenate([_unpack(by["steps"][i], 1) for i in order])
        out = []
        for keys, held, sizes, words, codes in zip(*(texts.column(c).to_pylist() for c in (
                "keys", "held", "counts", "words", "codes"))):
            words, codes = np.cumsum(_unpack(words, 8), dtype=np.uint64), _unpack(codes, 4).astype(np.int64)
            sizes = _unpack(sizes, 4).astype(np.int64)
            c = np.empty(len(words) + 1)
            c[_by_shard(words, shards, 64)[0]] = counts
            hashes, context = _pairs(words, codes, sizes)
            pairs, at = np.unique(hashes, return_inverse=True)
            found = np.empty(len(pairs), np.uint8)
            found[_by_shard(pairs, shards, _PAIR_BITS)[0]] = steps
            end = np.flatnonzero(words == _END)[0]
            c[-1] = c[end]  # every text that has an end has a beginning
            own, before = c[codes], c[context]
            alone = (own + 1) / base_of
            chance = chances(totals, found[at], own, before)
            docs = np.repeat(np.arange(len(sizes)), sizes)
            n = len(sizes)
            out.append(pa.table([
                pa.array(keys, kind), pa.array(held), pa.array(sizes), pa.array(np.bincount(docs, own > 0, n).astype(np.int64)),
                pa.array(np.full(n, totals.tokens, np.int64)), pa.array(np.bincount(docs, np.log10(alone), n)),
                pa.array(np.bincount(docs, np.log10(chance), n))], names=names))
        return pa.concat_tables(out)

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: id, ``held_out``, ``n_tokens``, ``n_known`` (tokens that occur in the texts learnt from),
    ``train_tokens``, ``base_score`` (add-one unigrams) and ``score`` (this model), both log10 chances of the text.

    The model learns from all rows where ``held_out`` is false; NULL counts as false. NULL and empty texts are one token,
    the end. Repeated ids and texts stay apart, other columns are ignored, an empty table gives no rows. With nothing to
    learn from, every token has the same chance. The input is read three times and must give the same rows in the same
    order, as a stored table does; other input raises. The segments of the model stay stored until the scratch folder is
    cleared.
    """
    shards = max(16, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("key"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    arrow = to_arrow_type(kind)
    taught = rows.where("not held").mapInArrow(
        _taught(shards), "shard int, words binary, word_counts binary, pairs binary, pair_counts binary")
    segments, _ = stored(taught.groupBy("shard").applyInArrow(
        lambda t: _segment(t), "shard int, words binary, word_counts binary, filter binary, size long, sums array<double>"),
        "segments")
    sums = segments.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s"))
    sums = np.array([r.s for r in sums.orderBy("pos").collect()] or [0.0] * (3 + len(_POWERS) + 2 * _STEPS))
    powers, known, total = np.split(sums[3:], [len(_POWERS), len(_POWERS) + _STEPS])
    power = float(_POWERS[np.abs(powers - sums[2]).argmin()])
    counts = np.where(known > 0, total / np.maximum(known, 1), count_of(np.arange(_STEPS)))
    totals = Totals(int(sums[0]), int(sums[1]), power, counts)
    asked = rows.mapInArrow(_asked(shards), "block string, shard int, words binary, pairs binary")
    answers = asked.groupBy("shard").cogroup(segments.drop("sums").groupBy("shard")).applyInArrow(
        lambda a, b: _answer(a, b), "block string, shard int, counts binary, steps binary")
    numbered = rows.mapInArrow(_numbered(arrow), T.StructType([
        T.StructField("block", T.StringType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("counts", T.BinaryType()),
        T.StructField("words", T.BinaryType()), T.StructField("codes", T.BinaryType())]))
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [kind, T.BooleanType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    return numbered.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scores(totals, shards, arrow, names), T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))
