"""Quality of texts by co-training.

Two logistic classifiers see different sides of a document: one its words and how they repeat, the other what is known
of the page: language, source, size and the make-up of its lines and characters. Each learns from labelled documents,
and in each round gives the labels it is surest of in an unlabelled pool to the other one. Both are calibrated on a part
of the labels that neither learns from, combined there, and applied to all documents in tasks.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.sample import bounded_sample
from strata.llm.textblocks import blocks, release, texts_of, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The samples that models learn from: labelled documents of each label, and documents of the unlabelled pool.
SAMPLE_PER_LABEL, POOL = 1000, 2000
ROUNDS, GIVEN_PER_ROUND, SURE = 4, 150, 0.95
# Documents below this score are rejected.
KEEP_FROM = 0.2
_WORDS, _BINS, _NAMES = 1 << 15, 18, 256
_STEPS = [0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.96, 0.98, 0.99]
_RESULT = "struct<score:double,text_score:double,page_score:double>"


class Sparse(NamedTuple):
    """Features of documents as (document, feature, value) triples, sorted by document."""

    docs: np.ndarray
    at: np.ndarray
    values: np.ndarray
    n: int


class Model(NamedTuple):
    edges: dict[str, np.ndarray]
    text: np.ndarray
    page: np.ndarray
    combine: np.ndarray


def _figures(column: pa.Array) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], Sparse]:
    """Numbers for the text view and for the page view of each text, and its hashed words."""
    n = len(column)
    words = words_of(column, letters=True)
    counts = np.bincount(words.docs, minlength=n)
    some = np.maximum(1, counts)
    same_doc = words.docs[1:] == words.docs[:-1]
    again = np.bincount(words.docs[1:], same_doc & (words.hashes[1:] == words.hashes[:-1]), n)
    bucket = (words.hashes % np.uint64(_WORDS)).astype(np.int64)
    pairs, times = np.unique(words.docs * _WORDS + bucket, return_counts=True)
    docs, at = pairs // _WORDS, pairs % _WORDS
    kinds = np.bincount(docs, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, docs, times)
    values = np.log1p(times)
    values /= np.sqrt(np.maximum(1e-9, np.bincount(docs, values ** 2, n)))[docs]
    text = {"repeats": again / some, "kinds": kinds / np.sqrt(some), "top": top / some,
            "length": np.bincount(words.docs, words.ends - words.starts, n) / some}
    data, offsets = texts_of(column)
    size = np.maximum(1, np.diff(offsets))
    running = np.zeros(len(data) + 1, np.int64)

    def share(hit: np.ndarray) -> np.ndarray:
        np.cumsum(hit, out=running[1:])
        return running[offsets[1:]] - running[offsets[:-1]]

    lines = share(data == 10) + 1
    upper = share((data >= 65) & (data <= 90))
    lower = share((data >= 97) & (data <= 122))
    chars = {"bars": (124,), "calls": (33, 63), "stops": (44, 46), "signs": (35, 36, 37, 38, 42, 64, 94, 126)}
    page = {"size": np.log(size), "lines": np.log(lines), "line": np.log(size / lines),
            "upper": upper / np.maximum(1, upper + lower), "digits": share((data >= 48) & (data <= 57)) / size}
    page |= {k: share(np.isin(data, v)) / size for k, v in chars.items()}
    return text, page, Sparse(docs, at, values, n)


def _one_hot(figures: dict[str, np.ndarray], edges: dict[str, np.ndarray], first: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (figures, documents) of binned figures, and the first number behind them."""
    rows = [first + i * _BINS + np.searchsorted(edges[k], v, "right") for i, (k, v) in enumerate(figures.items())]
    return np.stack(rows), first + len(rows) * _BINS


def _named(values: list, salt: str) -> np.ndarray:
    cache = {v: zlib.crc32(f"{salt}{v}".encode()) % _NAMES for v in set(values)}
    return np.fromiter(map(cache.__getitem__, values), np.int64, len(values))


def _views(edges: dict, column: pa.Array, names: list[list]) -> tuple[Sparse, Sparse]:
    text, page, words = _figures(column)
    n = words.n
    everyone = np.arange(n)
    hot, _ = _one_hot(text, edges, _WORDS)
    hot_page, end = _one_hot(page, edges, 0)
    hot_page = np.concatenate([hot_page, *[(end + i * _NAMES + _named(v, str(i)))[None] for i, v in enumerate(names)]])

    def sparse(parts: list[Sparse]) -> Sparse:
        docs = np.concatenate([p.docs for p in parts])
        order = np.argsort(docs, kind="stable")
        return Sparse(docs[order], np.concatenate([p.at for p in parts])[order],
                      np.concatenate([p.values for p in parts])[order], n)

    return (sparse([words, *[Sparse(everyone, row, np.full(n, 0.5), n) for row in hot]]),
            sparse([Sparse(everyone, row, np.full(n, 0.5), n) for row in hot_page]))


def _width(edges: dict, names: int) -> tuple[int, int]:
    return _WORDS + 4 * _BINS, 9 * _BINS + names * _NAMES


def _logit(weights: np.ndarray, x: Sparse) -> np.ndarray:
    return np.bincount(x.docs, weights[x.at] * x.values, x.n) + weights[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _train(x: Sparse, rows: np.ndarray, labels: np.ndarray, width: int, epochs: int = 25, batches: int = 8) -> np.ndarray:
    """Logistic regression by adaptive steps on some documents; each label weighs as much as the other."""
    weights, seen = np.zeros(width + 1), np.full(width + 1, 1e-3)
    cuts = np.searchsorted(x.docs, np.arange(x.n + 1))
    balance = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(rows)), batches):
            if not len(some):
                continue
            own = rows[some]
            size = cuts[own + 1] - cuts[own]
            pick = np.repeat(cuts[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            doc = np.repeat(np.arange(len(some)), size)
            z = np.bincount(doc, weights[x.at[pick]] * x.values[pick], len(some)) + weights[-1]
            error = balance[some] * (labels[some] - _sigmoid(z))
            grad = np.bincount(x.at[pick], error[doc] * x.values[pick], width + 1)
            grad[-1] = error.sum()
            grad -= 0.01 * weights
            seen += grad ** 2
            weights += 0.3 * grad / np.sqrt(seen)
    return weights


def _calibrate(z: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression of labels on rows of ``z`` and a constant, by damped Newton steps."""
    x, beta = np.concatenate([z, np.ones((1, z.shape[1]))]), np.zeros(len(z) + 1)
    for _ in range(25):
        p = _sigmoid(beta @ x)
        hess = (x * (weight * p * (1 - p))) @ x.T + 0.05 * np.eye(len(x))
        move = np.linalg.solve(hess, x @ (weight * (labels - p)) - 0.05 * beta)
        beta += move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
    return beta


def fit(texts: list[str], names: list[list], labels: np.ndarray, share: float) -> Model:
    """Co-train on documents with label 0, 1 or -1 (the pool); ``share`` is the real share of label 1."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    figures: dict[str, list] = {}
    for part in blocks(batch, "text"):
        for view in _figures(part.column("text"))[:2]:
            for k, v in view.items():
                figures.setdefault(k, []).append(v)
    edges = {k: np.unique(np.quantile(np.concatenate(v), _STEPS)) for k, v in figures.items()}
    done, views = 0, ([], [])
    for part in blocks(batch, "text"):
        for kept, x in zip(views, _views(edges, part.column("text"), [v[done:done + part.num_rows] for v in names])):
            kept.append(x._replace(docs=x.docs + done))
        done += part.num_rows
    views = [Sparse(*[np.concatenate([getattr(p, k) for p in v]) for k in ("docs", "at", "values")], done) for v in views]
    widths = _width(edges, len(names))
    known = np.flatnonzero(labels >= 0)
    kept = known[np.random.default_rng(1).permutation(len(known))]
    held, learn = kept[:len(kept) // 4], kept[len(kept) // 4:]
    given = [dict.fromkeys([]), dict.fromkeys([])]
    weights = [np.zeros(w + 1) for w in widths]
    for turn in range(ROUNDS + 1):
        for side in (0, 1):
            extra = np.array(list(given[side]), np.int64)
            rows = np.concatenate([learn, extra])
            marks = np.concatenate([labels[learn], np.array([given[side][i] for i in extra], np.int64)])
            weights[side] = _train(views[side], rows, marks, widths[side])
        if turn == ROUNDS:
            break
        for side in (0, 1):
            p = _sigmoid(_logit(weights[side], views[side]))
            pool = np.array([i for i in np.flatnonzero(labels < 0) if i not in given[1 - side]], np.int64)
            for label, sure in ((1, p[pool]), (0, 1 - p[pool])):
                best = pool[np.argsort(-sure, kind="stable")[:GIVEN_PER_ROUND]]
                sure = p[best] if label else 1 - p[best]
                given[1 - side].update(dict.fromkeys(best[sure >= SURE].tolist(), label))
    z = np.stack([_logit(w, x)[held] for w, x in zip(weights, views)])
    y = labels[held]
    own = max(1e-9, y.mean()) if len(y) else 0.5
    weight = np.where(y == 1, share / own, (1 - share) / max(1e-9, 1 - own))
    scale = [_calibrate(row[None], y, weight) for row in z]
    both = np.stack([s[0] * row + s[1] for s, row in zip(scale, z)])
    for w, s in zip(weights, scale):
        w *= s[0]
        w[-1] += s[1]
    return Model(edges, weights[0].astype(np.float32), weights[1].astype(np.float32), _calibrate(both, y, weight))


def _score(model: Model, column: pa.Array, names: list[list]) -> pa.Array:
    text, page = _views(model.edges, column, names)
    z = np.stack([_logit(model.text, text), _logit(model.page, page), np.ones(len(column))])
    return pa.StructArray.from_arrays(
        [pa.array(_sigmoid(model.combine @ z)), pa.array(_sigmoid(z[0])), pa.array(_sigmoid(z[1]))],
        ["score", "text_score", "page_score"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, text_col: str = "text", label_col: str = "quality",
          id_col: str = "doc_id", page_cols: tuple[str, ...] = ("lang", "source")) -> Model:
    """Fit on at most ``SAMPLE_PER_LABEL`` documents of each label and ``POOL`` others, where ``learn`` holds.

    Labels that are NULL, or of ids without text, teach nothing; where labels of an id differ, the higher counts; of
    texts with one id the first in order. Raises without any label.
    """
    marks = (labels.where(learn & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.col(label_col)).cast("int").alias("label")))
    total, ones = marks.agg(F.count("label"), F.sum("label")).first()
    if not total:
        raise ValueError("no labelled text to learn from")
    # Both samples are bounded, so their ids can go to all tasks that read texts.
    known = bounded_sample(marks, "label", "id", SAMPLE_PER_LABEL)
    others = bounded_sample(docs.where(learn).select(F.col(id_col).alias("id"), F.lit(-1).alias("label")), "label", "id", POOL)
    chosen = F.broadcast(known.unionByName(others).groupBy("id").agg(F.max("label").alias("label")))
    row = F.struct(F.col(text_col).alias("text"), *[F.col(c).alias(f"page{i}") for i, c in enumerate(page_cols)])
    sample = (docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), row.alias("row")).join(chosen, "id")
              .groupBy("id", "label").agg(F.min("row").alias("row")).orderBy("id").select("label", "row.*").toPandas())
    names = [list(sample[f"page{i}"]) for i in range(len(page_cols))]
    model = fit(list(sample["text"]), names, sample["label"].to_numpy(), (ones or 0) / total)
    del sample, names
    release()  # the driver keeps no room for the sample
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", page_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """All rows and columns plus ``score`` (chance of good quality), ``text_score``, ``page_score`` and ``keep``.

    Columns of these names are replaced. NULL and empty texts are scored as having no words on an empty page; NULL page
    columns are a value of their own. Whole texts are read; very long ones take no more than their own room.
    """

    def judge(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for text, *pages in columns:
            batch = pa.RecordBatch.from_arrays([text, *pages], ["text", *[f"page{i}" for i in range(len(pages))]])
            parts = [_score(model, p.column(0), [p.column(i + 1).to_pylist() for i in range(len(pages))])
                     for p in blocks(batch, "text")]
            yield pa.concat_arrays(parts)

    judge.__annotations__ = {"columns": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    said = F.arrow_udf(judge, _RESULT).asNondeterministic()(F.col(text_col), *[F.col(c) for c in page_cols])
    out = docs.withColumn("_said", said)
    return out.withColumns({
        "score": F.col("_said.score"), "text_score": F.col("_said.text_score"),
        "page_score": F.col("_said.page_score"), "keep": F.col("_said.score") >= KEEP_FROM}).drop("_said")
