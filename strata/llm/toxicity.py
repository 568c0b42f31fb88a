"""Toxic spans and scores: a linear-chain conditional random field over the words of a text.

Training texts carry one label each, so their words are labelled first: in a toxic text, words (or word beginnings)
that are far more frequent in toxic texts than in others are toxic, everything else is not. The field learns weights of
words and word beginnings and of the steps between neighbours; forward-backward marginals give the toxic words and,
pooled and calibrated, the score of a text.
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
from strata.llm.textblocks import Words, blocks, mix, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The sample that a model learns from: so many texts of each label.
SAMPLE_PER_LABEL = 1500
# Steps learn from runs of so many words; scoring runs over whole texts.
SEGMENT = 64
BUCKETS = 1 << 18
BEGINNINGS = (4, 5)
# Evidence (G-test) and ratio of rates from which a word of a toxic text counts as toxic.
EVIDENCE, RATIO = 20.0, 5.0
THRESHOLD = 0.3
_LIMIT = 15.0
_RESULT = "struct<score:double,toxic_words:double,spans:array<struct<start:int,end:int>>>"


class Model(NamedTuple):
    weights: np.ndarray
    steps: np.ndarray  # log weights of the steps 0-0, 0-1, 1-0, 1-1
    calibration: np.ndarray


def features_of(words: Words) -> np.ndarray:
    """Hashes (kinds, words): the word itself and its beginnings."""
    lengths = words.ends - words.starts
    rows = [words.hashes]
    data = words.data.copy()
    data[(data >= 65) & (data < 91)] += 32
    for size in BEGINNINGS:
        h = np.zeros(len(words.starts), np.uint64)
        for k in range(size):
            char = data[np.minimum(words.starts + k, max(0, len(data) - 1))].astype(np.uint64) if len(data) else h
            h = np.where(lengths > k, mix(h + char + np.uint64(k + 1)), h)
        rows.append(mix(h + np.uint64(size)))
    return np.stack(rows)


def marginals(eu: np.ndarray, starts: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward odds and backward ratios of state 1 at each word of many sequences, step by step over all at once.

    ``eu`` holds each word's odds by itself. The odds of the marginal are the product of both results.
    """
    t00, t01, t10, t11 = np.exp(steps)
    forward, backward = np.ones(len(eu)), np.ones(len(eu))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    state = np.ones(0)
    for t in range(longest):
        at = starts[:active[t]] + t
        if t:
            state = state[:len(at)]
            state = eu[at] * (t01 + t11 * state) / (t00 + t10 * state)
        else:
            state = eu[at]
        forward[at] = state
    state = np.ones(0)
    for t in range(longest - 1, 0, -1):
        at = starts[:active[t]] + t
        grown = np.ones(len(at))
        grown[:len(state)] = state
        grown *= eu[at]
        state = (t10 + t11 * grown) / (t00 + t01 * grown)
        backward[at - 1] = state
    return forward, backward


def _odds(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    sums = weights[BUCKETS] + sum(weights[(f % np.uint64(BUCKETS)).astype(np.int64)] for f in features)
    return np.exp(np.clip(sums, -_LIMIT, _LIMIT))


def _frequent_in(features: np.ndarray, docs: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which words are far more frequent in toxic texts, as words or by their beginning.

    A word counts once for each word that stands before it, so that copies of a text count as one text would.
    """
    marked = np.zeros(features.shape[1], bool)
    before = np.zeros(features.shape[1], np.uint64)
    if len(before):
        before[1:] = np.where(docs[1:] == docs[:-1], features[0, :-1], 0)
    bad = toxic[docs]
    for row in features:
        kinds, codes = np.unique(row, return_inverse=True)
        pairs = mix(before + row * np.uint64(3))
        counts = []
        for side in (bad, ~bad):
            _, at = np.unique(pairs[side], return_index=True)
            counts.append(np.bincount(codes[side][at], minlength=len(kinds)).astype(float))
        a, b = counts
        n_toxic, n_clean = max(1.0, a.sum()), max(1.0, b.sum())
        share = n_toxic / (n_toxic + n_clean)
        with np.errstate(divide="ignore", invalid="ignore"):
            g = 2 * (np.where(a > 0, a * np.log(a / ((a + b) * share)), 0)
                     + np.where(b > 0, b * np.log(b / ((a + b) * (1 - share))), 0))
        strong = (g >= EVIDENCE) & ((a + 0.1) / n_toxic >= RATIO * (b + 0.1) / n_clean)
        marked |= strong[codes]
    return marked


def _pool(docs: np.ndarray, odds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected toxic words of each text, and the two figures that its score is made from."""
    p = odds / (1 + odds)
    expected = np.bincount(docs, p, n)
    top = np.full(n, 1e-6)
    np.maximum.at(top, docs, odds)
    # Squares, so that the many small chances of a very long text don't add up to evidence.
    firm = np.log10(np.bincount(docs, p * p, n) + 1e-4)
    return expected, np.stack([np.log(np.clip(top, 1e-6, 1e6)) / 4, firm, np.ones(n)])


def _calibrated(calibration: np.ndarray, figures: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(calibration @ figures, -30, 30)))


def _read(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and text numbers of all words, block by block."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    features, docs, done = [], [], 0
    for part in blocks(batch, "text"):
        words = words_of(part.column("text"), letters=True)
        features.append(features_of(words))
        docs.append(words.docs + done)
        done += part.num_rows
    if not docs:
        return np.zeros((1 + len(BEGINNINGS), 0), np.uint64), np.zeros(0, np.int64)
    return np.concatenate(features, axis=1), np.concatenate(docs)


def fit(texts: list[str], labels: list[int], share: float | None = None, epochs: int = 6, batches: int = 12,
        seed: int = 0) -> Model:
    """Train on whole texts; scores are calibrated to the ``share`` of toxic texts, by default that of the sample."""
    toxic = np.array(labels, bool)
    features, docs = _read(texts)
    truth = _frequent_in(features, docs, toxic) & toxic[docs]
    counts = np.bincount(docs, minlength=len(texts))
    pieces = -(-counts // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), pieces)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = (np.cumsum(counts) - counts)[owner] + first * SEGMENT
    lengths = np.minimum(SEGMENT, counts[owner] - first * SEGMENT)
    weights, steps = np.zeros(BUCKETS + 1), np.zeros(4)
    weights[BUCKETS] = -3.0
    seen, seen_steps = np.full(BUCKETS + 1, 1e-6), np.full(4, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(starts)), batches):
            if not len(some):
                continue
            size = lengths[some]
            at = np.repeat(starts[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            f, y = features[:, at], truth[at]
            eu = _odds(weights, f)
            begin = np.cumsum(size) - size
            forward, backward = marginals(eu, begin, size, steps)
            odds = forward * backward
            error = y - odds / (1 + odds)
            grad = np.zeros(BUCKETS + 1)
            for row in f:
                grad[:BUCKETS] += np.bincount((row % np.uint64(BUCKETS)).astype(np.int64), error, BUCKETS)
            grad[BUCKETS] = error.sum()
            inner = np.ones(len(at), bool)
            inner[begin] = False
            nxt = np.flatnonzero(inner)
            after = eu[nxt] * backward[nxt]
            t = np.exp(steps)[:, None]
            joint = np.stack([np.ones(len(nxt)), after, forward[nxt - 1], forward[nxt - 1] * after]) * t
            joint /= joint.sum(axis=0)
            real = np.bincount(2 * y[nxt - 1] + y[nxt], minlength=4)
            grad_steps = real - joint.sum(axis=1) - 0.01 * steps
            grad -= 0.01 * weights
            seen += grad ** 2
            seen_steps += grad_steps ** 2
            weights += 0.7 * grad / np.sqrt(seen)
            steps += 0.2 * grad_steps / np.sqrt(seen_steps)
    model = Model(weights.astype(np.float32), steps, np.zeros(3))
    forward, backward = marginals(_odds(model.weights, features), np.cumsum(counts) - counts, counts, steps)
    _, figures = _pool(docs, forward * backward, len(texts))
    calibration = np.zeros(3)
    penalty = np.array([0.02, 0.02, 1e-4])
    own = toxic.mean() if len(toxic) else 0.5
    share = own if share is None else share
    weight = np.where(toxic, share / max(own, 1e-9), (1 - share) / max(1 - own, 1e-9))
    for _ in range(25):  # Newton steps of a logistic regression with a small penalty
        p = _calibrated(calibration, figures)
        hess = (figures * (weight * p * (1 - p))) @ figures.T + np.diag(penalty)
        move = np.linalg.solve(hess, figures @ (weight * (toxic - p)) - penalty * calibration)
        calibration += move * min(1.0, 3.0 / np.abs(move).max())
    return model._replace(calibration=calibration)


def _score(model: Model, column: pa.Array) -> pa.Array:
    words = words_of(column, letters=True)
    n = len(column)
    counts = np.bincount(words.docs, minlength=n)
    eu = _odds(model.weights, features_of(words))
    forward, backward = marginals(eu, np.cumsum(counts) - counts, counts, model.steps)
    odds = forward * backward
    expected, figures = _pool(words.docs, odds, n)
    hits = np.flatnonzero(odds >= 1)
    if len(hits):  # places in characters: bytes that begin one, counted from the beginning of the text
        chars = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum((words.data & 0xC0) != 0x80, out=chars[1:])
        base = chars[words.offsets[words.docs[hits]]]
        start, end = chars[words.starts[hits]] - base, chars[words.ends[hits]] - base
    else:
        start = end = np.zeros(0, np.int64)
    cuts = np.searchsorted(words.docs[hits], np.arange(n + 1))
    spans = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"]))
    return pa.StructArray.from_arrays(
        [pa.array(_calibrated(model.calibration, figures)), pa.array(expected), spans], ["score", "toxic_words", "spans"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, text_col: str = "text", label_col: str = "toxic",
          id_col: str = "doc_id") -> Model:
    """Fit on at most ``SAMPLE_PER_LABEL`` labelled texts of each label among the rows where ``learn`` holds.

    Labels that are NULL, or of
    ids without a text, teach nothing; where labels of an id differ, the higher counts. All rows of
    a chosen id are learnt from. Raises without any label.
    """
    marks = (labels.where(learn & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.col(label_col)).cast("int").alias("label")))
    # The sample is bounded, so its ids can go to all tasks that read texts.
    chosen = F.broadcast(bounded_sample(marks, "label", "id", SAMPLE_PER_LABEL))
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
              .join(chosen, "id").orderBy("label", "id", "text").select("text", "label").toPandas())
    if not len(sample):
        raise ValueError("no labelled text to learn from")
    share = marks.agg(F.avg("label")).first()[0]
    return fit(list(sample["text"]), list(sample["label"]), share)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns plus ``score`` (0 to 1), ``predicted`` (1 from ``THRESHOLD``), ``toxic_words`` (expected
    number) and ``spans`` (first character and end of each word that is toxic rather than not).

    Columns of these names are replaced. Whole texts are scored; NULL and empty texts get the score of no evidence.
    """

    def tag(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            parts = [_score(model, part.column("text")) for part in blocks(batch, "text", 1 << 22)]
            yield pa.concat_arrays(parts) if parts else _score(model, column)

    said = F.arrow_udf(tag, _RESULT).asNondeterministic()(text_col)
    out = docs.withColumn("_said", said)
    return out.withColumns({
        "score": F.col("_said.score"), "predicted": (F.col("_said.score") >= THRESHOLD).cast("int"),
        "toxic_words": F.col("_said.toxic_words"), "spans": F.col("_said.spans")}).drop("_said")
