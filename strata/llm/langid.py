"""Language of texts: a bidirectional gated recurrent network over UTF-8 bytes.

Each direction carries a small state through windows of ``WINDOW`` bytes (states start afresh at each window), both
states label every position, and the positions' log probabilities are pooled into those of the document. Training is
backpropagation through time in NumPy on the driver, on a bounded sample; labelling runs in tasks on all bytes.
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
from strata.llm.textblocks import blocks, release, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 64
STATE = 8
# The sample that a model learns from: so many documents of each language, so many windows of each document.
SAMPLE_PER_LANGUAGE, SAMPLE_WINDOWS = 400, 5
UNDETERMINED = "und"
# Pooled evidence counts as that of so many independent positions at most.
_EVIDENCE = 40.0
_COLUMNS = 4096
# A byte counts for the language that has more than half of its probability.
_HALF = -0.6931
_KINDS = "struct<lang:string,score:double,share:double>"


class Model(NamedTuple):
    languages: list[str]
    params: dict[str, np.ndarray]


def _squash(x: np.ndarray, spare: np.ndarray) -> None:
    """x / (1 + |x|) in place: the network's activation, in -1 to 1."""
    np.abs(x, out=spare)
    spare += 1
    x /= spare


def _run(params: dict, side: str, chars: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States (STATE, steps, windows) of one direction over bytes (steps, windows), and what its gradient needs."""
    steps, n = chars.shape
    table, recur = params["in_" + side], params["re_" + side]
    states, saved = np.empty((STATE, steps, n), np.float32), []
    h = np.zeros((STATE, n), np.float32)
    x, u = np.empty((3 * STATE, n), np.float32), np.empty((3 * STATE, n), np.float32)
    spare = np.empty((2 * STATE, n), np.float32)
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        np.take(table, chars[t], axis=1, out=x, mode="clip")
        np.matmul(recur, h, out=u)
        gates = x[:2 * STATE]
        gates += u[:2 * STATE]
        _squash(gates, spare)
        gates *= 0.5
        gates += 0.5
        new = x[2 * STATE:]
        np.multiply(gates[STATE:], u[2 * STATE:], out=spare[:STATE])
        new += spare[:STATE]
        _squash(new, spare[:STATE])
        before = h
        h = states[:, t]
        np.subtract(before, new, out=h)
        h *= gates[:STATE]
        h += new
        if keep:
            saved.append((t, x.copy(), u[2 * STATE:].copy(), before))
    return states, saved


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of the activation, from its value."""
    return (1 - np.abs(y)) ** 2


def _log_probabilities(params: dict, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    shape = forward.shape[1:]
    scores = params["out_f"] @ forward.reshape(STATE, -1)
    scores += params["out_b"] @ backward.reshape(STATE, -1)
    scores += params["bias"][:, None]
    top = scores[0].copy()
    for row in scores[1:]:
        np.maximum(top, row, out=top)
    scores -= top
    total = np.zeros_like(top)
    for row in scores:
        total += np.exp(row)
    scores -= np.log(total, out=total)
    return scores.reshape(len(scores), *shape)


def _gradients(params: dict, chars: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean loss per position and its gradient by backpropagation through time."""
    runs = {s: _run(params, s, chars, keep=True) for s in "fb"}
    probs = np.exp(_log_probabilities(params, runs["f"][0], runs["b"][0]))
    total = max(1, int(inside.sum()))
    columns = np.arange(chars.shape[1])
    loss = float(-(np.log(probs[labels, :, columns].T + 1e-9) * inside).sum() / total)
    probs[labels, :, columns] -= 1
    delta = probs * (inside / np.float32(total))
    grads = {"bias": delta.sum(axis=(1, 2))}
    for side in "fb":
        states, saved = runs[side]
        grads["out_" + side] = np.tensordot(delta, states, ((1, 2), (1, 2)))
        to_state = np.tensordot(params["out_" + side].T, delta, 1)
        recur = params["re_" + side]
        d_in, d_re = np.zeros_like(params["in_" + side]), np.zeros_like(recur)
        carry = np.zeros((STATE, chars.shape[1]), np.float32)
        for t, x, u_new, before in reversed(saved):
            dh = to_state[:, t] + carry
            z, r, new = x[:STATE], x[STATE:2 * STATE], x[2 * STATE:]
            d_new = dh * (1 - z) * _slope(new)
            d_gates = np.concatenate([dh * (before - new), d_new * u_new])
            d_gates *= 0.5 * _slope(2 * x[:2 * STATE] - 1)
            d_u = np.concatenate([d_gates, d_new * r])
            d_x = np.concatenate([d_gates, d_new])
            carry = dh * z + recur.T @ d_u
            d_re += d_u @ before.T
            for row in range(3 * STATE):
                d_in[row] += np.bincount(chars[t], d_x[row], 256)
        grads["in_" + side], grads["re_" + side] = d_in, d_re
    return loss, grads


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text of each window."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    docs = np.repeat(np.arange(len(lengths)), counts)
    first = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[docs] + first * WINDOW
    return starts, np.minimum(starts + WINDOW, offsets[docs + 1]), docs


def _matrix(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    inside = at < ends[None, :]
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0), inside


def fit(texts: list[str], languages: list[str], epochs: int = 6, seed: int = 0) -> Model:
    """Train on whole texts with their languages; windows are spread evenly over each text."""
    names = sorted(set(languages))
    data, offsets = texts_of(pa.array(texts, pa.large_string()))
    starts, ends, docs = _windows(data, offsets)
    counts = np.bincount(docs, minlength=len(texts))
    place = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    every = np.maximum(1, counts // SAMPLE_WINDOWS)[docs] if len(docs) else docs
    chosen = np.flatnonzero((place % every == 0) & (place // every < SAMPLE_WINDOWS)) if len(docs) else docs
    chars, inside = _matrix(data, starts[chosen], ends[chosen]) if len(chosen) else (np.zeros((WINDOW, 0), np.int64),) * 2
    labels = np.searchsorted(names, np.array(languages)[docs[chosen]]) if len(chosen) else np.zeros(0, np.int64)
    rng = np.random.default_rng(seed)
    params = {"bias": np.zeros(len(names), np.float32)}
    for side in "fb":
        params["in_" + side] = rng.normal(0, 0.5, (3 * STATE, 256)).astype(np.float32)
        params["re_" + side] = rng.normal(0, 0.3, (3 * STATE, STATE)).astype(np.float32)
        params["out_" + side] = rng.normal(0, 0.3, (len(names), STATE)).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    batch, step = max(16, min(256, len(chosen) // 16)), 0
    total = epochs * max(1, len(chosen) // batch)
    for _ in range(epochs if len(names) > 1 else 0):
        order = rng.permutation(len(chosen))
        for a in range(0, len(order) - batch + 1, batch):
            some = order[a:a + batch]
            _, grads = _gradients(params, chars[:, some], inside[:, some], labels[some])
            step += 1
            rate = 0.02 * (1 - 0.9 * step / total)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                params[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                              / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return Model(names, params)


def label_positions(model: Model, chars: np.ndarray) -> np.ndarray:
    """Log probability (language, position, window) of each language at each byte."""
    return _log_probabilities(model.params, *(_run(model.params, s, chars)[0] for s in "fb"))


def _label(model: Model, column: pa.Array) -> pa.Array:
    data, offsets = texts_of(column)
    n, k = len(column), len(model.languages)
    sums, votes = np.zeros((k, n)), np.zeros((k, n))
    starts, ends, docs = _windows(data, offsets)
    for a in range(0, len(starts), _COLUMNS):
        some = slice(a, a + _COLUMNS)
        chars, inside = _matrix(data, starts[some], ends[some])
        scores = label_positions(model, chars)
        for j in range(k):
            scores[j] *= inside
            sums[j] += np.bincount(docs[some], scores[j].sum(axis=0), n)
            votes[j] += np.bincount(docs[some], ((scores[j] > _HALF) & inside).sum(axis=0), n)
    size = np.maximum(1, np.diff(offsets))
    pooled = sums / size * np.minimum(size, _EVIDENCE)
    pooled -= pooled.max(axis=0, keepdims=True)
    probs = np.exp(pooled)
    probs /= probs.sum(axis=0, keepdims=True)
    best = probs.argmax(axis=0)
    at = np.arange(n)
    return pa.StructArray.from_arrays(
        [pa.array(np.array(model.languages, object)[best], pa.string()), pa.array(probs[best, at]),
         pa.array(votes[best, at] / size)], ["lang", "score", "share"])


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Fit on at most ``SAMPLE_PER_LANGUAGE`` texts of each language among the rows where ``learn`` holds.

    Rows with NULL or empty text or NULL language teach nothing; without any language left there is nothing to fit and
    this raises.
    """
    rows = (docs.where(learn).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where("text is not null and text != ''"))
    sample = bounded_sample(rows, "lang", "id", SAMPLE_PER_LANGUAGE).select("text", "lang").toPandas()
    if not len(sample):
        raise ValueError("no text with a language to learn from")
    model = fit(list(sample["text"]), list(sample["lang"]))
    del sample
    release()  # the driver keeps no room for the sample
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns plus ``lang_pred``, ``score`` (0 to 1) and ``share`` (of bytes labelled so).

    Columns of these names are replaced. A text that is NULL or has no letter is ``und`` with score 0.
    """

    def label(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            yield pa.concat_arrays([_label(model, part.column("text")) for part in blocks(batch, "text", 1 << 22)])

    label.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    said = F.arrow_udf(label, _KINDS).asNondeterministic()(text_col)
    sure = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    out = docs.withColumn("_said", said)
    return out.withColumns({
        "lang_pred": F.when(sure, F.col("_said.lang")).otherwise(UNDETERMINED),
        "score": F.when(sure, F.col("_said.score")).otherwise(0.0),
        "share": F.when(sure, F.col("_said.share")).otherwise(0.0)}).drop("_said")
