"""Quality rules: counts that any reader can check, and a classifier of hashed word and character n-grams.

The base rules reject texts of a few words and texts that mostly repeat themselves. Texts that pass are judged by a
logistic regression on hashed n-grams (words: 1 and 2, characters: 3 and 4, case kept), trained on labelled texts and
calibrated on labelled texts it hasn't learned from. A text's features are the shares of its n-grams, so its score is a
mean over positions: scoring adds up looked-up weights and sorts nothing.

Equal lines, words and n-grams are told by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.sample import bounded_sample
from strata.llm.textblocks import blocks, mix, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_WORDS, WINDOW, MOST_REPEATED = 20, 8, 30  # of 100 words so many may be in windows that are found again
KEEP_FROM = 0.2  # chance of good quality
SAMPLE_PER_LABEL = 1500
_SYMBOLS = tuple(b"#*$%&|<>")
_BUCKETS = 1 << 15  # of each kind of n-gram
_KINDS = ("word", "pair", "char3", "char4")
_SCALE = 10.0
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_powers: dict = {}


class Model(NamedTuple):
    """Weights of the n-grams (kinds one after the other, then a constant), and slope and constant of the calibration."""

    weights: np.ndarray
    slope: float
    constant: float


class Block(NamedTuple):
    """What the texts of a block are made of. ``running`` are prefix sums, from which any run of bytes gets its hash."""

    data: np.ndarray
    offsets: np.ndarray
    running: np.ndarray
    inverse: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray
    words: np.ndarray


def _powers_of(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, 1 << 19), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def read_block(column: pa.Array) -> Block:
    data, offsets = texts_of(column)
    n = len(data)
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * _powers_of(_BASE, n), out=running[1:])
    inverse = _powers_of(_INVERSE, n + 1)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    docs = np.searchsorted(offsets, starts, "right") - 1
    block = Block(data, offsets, running, inverse, starts, ends, docs, np.zeros(0, np.uint64))
    return block._replace(words=_hashes(block, starts, ends))


def _hashes(b: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((b.running[ends] - b.running[starts]) * b.inverse[starts] + (ends - starts).astype(np.uint64))


def _per_text(b: Block, hit: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    sums = np.concatenate([[0], np.cumsum(hit)])
    return sums[b.offsets[1:]] - sums[b.offsets[:-1]]


def _found_again(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether its text has an equal one, and whether it is the first of those."""
    order = np.lexsort((np.arange(len(docs)), hashes, docs))
    d, h = docs[order], hashes[order]
    same = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    before = np.concatenate([[False], same])[:len(docs)]
    after = np.concatenate([same, [False]])[:len(docs)]
    again, first = np.zeros(len(docs), bool), np.zeros(len(docs), bool)
    again[order], first[order] = before | after, ~before
    return again, first


def counts_of(b: Block) -> dict[str, np.ndarray]:
    n = len(b.offsets) - 1
    inside = np.zeros(len(b.data) + 1, np.int64)
    np.add.at(inside, b.starts, 1)
    np.add.at(inside, b.ends, -1)
    inside = np.cumsum(inside)[:-1] > 0
    # Lines begin with a text and behind each line feed.
    feed = np.flatnonzero(b.data == 10)
    line_starts = np.sort(np.concatenate([b.offsets[:-1], feed + 1]))
    line_docs = np.searchsorted(b.offsets[1:], line_starts, "right")
    line_ends = np.sort(np.concatenate([b.offsets[1:], feed]))
    full = np.searchsorted(b.starts, line_ends) > np.searchsorted(b.starts, line_starts)
    # A line feed at the very end of a text begins an empty line that seems to be of the next text; it holds no word.
    line_starts, line_ends, line_docs = line_starts[full], line_ends[full], line_docs[full]
    _, first_line = _found_again(line_docs, _hashes(b, line_starts, line_ends))
    words = len(b.words)
    at = np.flatnonzero(b.docs[WINDOW - 1:] == b.docs[:words - WINDOW + 1]) if words >= WINDOW else np.zeros(0, np.int64)
    window = np.zeros(len(at), np.uint64)
    for k in range(WINDOW):
        window += b.words[at + k] * np.uint64(pow(_INVERSE, k + 3, 1 << 64))
    again, _ = _found_again(b.docs[at], window)
    cover = np.zeros(words + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + WINDOW, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    return {
        "n_words": np.bincount(b.docs, minlength=n), "word_chars": _per_text(b, inside & ((b.data & 0xC0) != 0x80)),
        "n_symbols": _per_text(b, np.isin(b.data, _SYMBOLS)),
        "n_dup_lines": np.bincount(line_docs[~first_line], minlength=n),
        "n_repeat_words": np.bincount(b.docs[repeated], minlength=n)}


def _grams(b: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: text and bucket of each place that has one."""
    kinds = []
    kinds.append((b.docs, b.words))
    pair = np.flatnonzero(b.docs[1:] == b.docs[:-1])
    kinds.append((b.docs[pair], mix(b.words[pair] + b.words[pair + 1] * np.uint64(_BASE))))
    chars = np.append(np.flatnonzero((b.data & 0xC0) != 0x80), len(b.data))
    docs = np.searchsorted(b.offsets, chars[:-1], "right") - 1
    for size in (3, 4):
        if len(docs) < size:
            kinds.append((docs[:0], np.zeros(0, np.uint64)))
            continue
        here = np.flatnonzero(docs[size - 1:] == docs[:len(docs) - size + 1])
        kinds.append((docs[here], _hashes(b, chars[here], chars[here + size])))
    for k, (docs, hashes) in enumerate(kinds):
        yield docs, (hashes % np.uint64(_BUCKETS)).astype(np.int64) + k * _BUCKETS


def _logits(b: Block, model: Model) -> np.ndarray:
    n = len(b.offsets) - 1
    z = np.full(n, float(model.weights[-1]))
    for docs, at in _grams(b):
        z += _SCALE * np.bincount(docs, model.weights[at], n) / np.maximum(1, np.bincount(docs, minlength=n))
    return model.slope * z + model.constant


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(column: pa.Array) -> pa.Array:
    """The n-grams of each text as a list of (bucket, share)."""
    batch, parts = pa.RecordBatch.from_arrays([column], ["text"]), []
    kind = pa.list_(pa.struct([("at", pa.int32()), ("share", pa.float32())]))
    for rows in blocks(batch, "text"):
        b = read_block(rows.column(0))
        n, width = rows.num_rows, len(_KINDS) * _BUCKETS
        docs, ats, shares = [], [], []
        for doc, at in _grams(b):
            key, times = np.unique(doc * width + at, return_counts=True)
            docs.append(key // width)
            ats.append(key % width)
            shares.append(times / np.bincount(doc, minlength=n)[key // width])
        docs = np.concatenate(docs)
        order = np.argsort(docs, kind="stable")
        values = pa.StructArray.from_arrays([pa.array(np.concatenate(ats)[order], pa.int32()), pa.array(
            np.concatenate(shares)[order], pa.float32())], ["at", "share"])
        cuts = np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=n))])
        parts.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values).cast(kind))
    return pa.chunked_array(parts, kind).combine_chunks()


_features.__annotations__ = {"column": pa.Array, "return": pa.Array}


def fit(docs: np.ndarray, at: np.ndarray, shares: np.ndarray, labels: np.ndarray, share_good: float) -> Model:
    """Logistic regression on three quarters of the labelled texts, calibrated on the last one to the real share of label 1."""
    width = len(_KINDS) * _BUCKETS + 1
    cuts = np.searchsorted(docs, np.arange(len(labels) + 1))
    order = np.random.default_rng(1).permutation(len(labels))
    held, learn = order[:len(order) // 4], order[len(order) // 4:]
    balance = np.where(labels == 1, 0.5 / max(1, (labels[learn] == 1).sum()),
                       0.5 / max(1, (labels[learn] == 0).sum())) * len(learn)
    weights, seen, rng = np.zeros(width), np.full(width, 1e-3), np.random.default_rng(0)

    def some(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = cuts[rows + 1] - cuts[rows]
        pick = np.repeat(cuts[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.repeat(np.arange(len(rows)), size), at[pick], _SCALE * shares[pick]

    for _ in range(20):
        for rows in np.array_split(rng.permutation(learn), max(1, len(learn) // 100)):
            doc, where, value = some(rows)
            z = np.bincount(doc, weights[where] * value, len(rows)) + weights[-1]
            error = balance[rows] * (labels[rows] - _sigmoid(z)) / max(1, len(rows))
            grad = np.bincount(where, error[doc] * value, width) - 1e-5 * weights
            grad[-1] = error.sum()
            seen += grad ** 2
            weights += 0.3 * grad / np.sqrt(seen)
    weights = weights.astype(np.float32)
    rows = held if len(np.unique(labels[held])) > 1 else order
    doc, where, value = some(rows)
    z, y = np.bincount(doc, weights[where] * value, len(rows)) + weights[-1], labels[rows]
    own = np.clip(y.mean() if len(y) else 0.5, 1e-9, 1 - 1e-9)
    weight = np.where(y == 1, share_good / own, (1 - share_good) / (1 - own))
    # Newton steps with a small pull to slope 1, so that classes which don't overlap get a finite slope.
    beta, x = np.array([1.0, 0.0]), np.stack([z, np.ones(len(z))])
    for _ in range(50):
        p = _sigmoid(beta @ x)
        hess = (x * (weight * p * (1 - p))) @ x.T + 0.1 * np.eye(2)
        move = np.linalg.solve(hess, x @ (weight * (y - p)) - 0.1 * (beta - [1.0, 0.0]))
        beta = beta + move * min(1.0, 1.0 / max(1e-9, np.abs(move).max()))
    return Model(weights, float(beta[0]), float(beta[1]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, text_col: str = "text", label_col: str = "quality",
          id_col: str = "doc_id", per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """Fit on at most ``per_label`` labelled texts of each label, of the ids for which ``learn`` holds.

    NULL labels and labels without a text teach nothing; an id with both labels counts as good, of several texts with one
    id the first in order is read. Without any label to learn from there is no model. Texts become n-gram shares in the
    tasks that read them, so the driver gets a bounded number of figures however long the texts are.
    """
    marks = (labels.where(learn & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.col(label_col)).cast("int").alias("label")))
    total, ones = marks.agg(F.count("label"), F.sum("label")).first()
    if not total:
        return None
    # Bounded, so these ids can go to all tasks that read texts.
    chosen = F.broadcast(bounded_sample(marks, "label", "id", per_label))
    known = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text")).orderBy("id"))
    got = known.select("label", F.arrow_udf(_features, "array<struct<at:int,share:float>>")("text").alias("grams")).toArrow()
    if not got.num_rows:
        return None
    grams = got.column("grams").combine_chunks()
    size = grams.value_lengths().to_numpy()
    flat = grams.flatten()
    return fit(np.repeat(np.arange(len(size)), size), flat.field("at").to_numpy().astype(np.int64),
               flat.field("share").to_numpy().astype(np.float64), got.column("label").to_numpy(), ones / total)


def apply(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """All rows and columns plus the counts, ``base_failed``, ``score`` (chance of good quality) and ``kept``.

    ``n_words``, ``word_chars`` (characters in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that equal one
    before), ``n_repeat_words`` (words in windows of eight words that the text has more than once). Columns of these
    names are replaced. NULL and empty texts have no word and fail the base rules; repeated rows are judged alike. With
    no model the base rules decide and the score is NULL. Each batch is read in blocks of whole texts.
    """

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([*[(c, pa.int64()) for c in _COUNTS], ("score", pa.float64())])
        for column in columns:
            parts = []
            for rows in blocks(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
                b = read_block(rows.column(0))
                counts = counts_of(b)
                score = pa.nulls(rows.num_rows, pa.float64()) if model is None else pa.array(_sigmoid(_logits(b, model)))
                parts.append(pa.StructArray.from_arrays([*[pa.array(counts[c], pa.int64()) for c in _COUNTS], score],
                                                        [*_COUNTS, "score"]))
            yield pa.chunked_array(parts, kind).combine_chunks()

    judge.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    said = F.arrow_udf(judge, f"struct<{','.join(c + ':bigint' for c in _COUNTS)},score:double>").asNondeterministic()
    out = docs.withColumn("_said", said(F.col(text_col).cast("string")))
    failed = (F.col("_said.n_words") < LEAST_WORDS) | (
        100 * F.col("_said.n_repeat_words") > MOST_REPEATED * F.col("_said.n_words"))
    return out.withColumns({
        **{c: F.col(f"_said.{c}") for c in _COUNTS}, "score": F.col("_said.score"), "base_failed": failed,
        "kept": ~failed & F.coalesce(F.col("_said.score") >= KEEP_FROM, F.lit(True))}).drop("_said")
