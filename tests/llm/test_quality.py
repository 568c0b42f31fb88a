"""Quality: held-out labels, pseudo-labels from the other view, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import quality
from strata.llm.quality_queries import op5_quality_classifier


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = op5_quality_classifier(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r for r in rows if r.quality], [r for r in rows if not r.quality]
    assert np.mean([r.keep for r in good]) > 0.85 and np.mean([not r.keep for r in bad]) > 0.4
    assert np.mean([r.score for r in good]) > np.mean([r.score for r in bad]) + 0.3


def made(n, rng):
    rows = []
    for i in range(n):
        good = i % 2
        words = [rng.choice("tree lake stone wind river cloud path".split()) for _ in range(30)]
        text = " ".join(words) if good else " ".join(words[:2] * 15)
        rows.append((i, text, "en", f"s{good}" if rng.random() < 0.9 else "s9", good))
    return rows


def test_pseudo_labels_reach_the_other_view():
    rows = made(300, random.Random(1))
    labels = np.array([r[4] if i < 60 else -1 for i, r in enumerate(rows)])
    model = quality.fit([r[1] for r in rows], [[r[2] for r in rows], [r[3] for r in rows]], labels, 0.5)
    import pyarrow as pa
    got = quality._score(model, pa.array([r[1] for r in rows]), [[r[2] for r in rows], [r[3] for r in rows]]).to_pylist()
    for view in ("score", "text_score"):
        assert np.mean([(g[view] > 0.5) == bool(r[4]) for g, r in zip(got, rows)]) > 0.95


def test_odd_rows(spark):
    rows = made(200, random.Random(2))
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows[:120]] + [(5000, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.lit(True))
    odd = spark.createDataFrame([(1, None, None, None, 2.0), (2, "", "xx", "s1", 2.0), (3, "tree lake " * 50000, "en", None, 2.0),
                                 (3, "tree lake " * 50000, "en", None, 2.0)],
                                "doc_id long, text string, lang string, source string, score double")
    out = quality.score(odd, model).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    assert quality.score(odd.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        quality.train(docs, labels, F.lit(False))
