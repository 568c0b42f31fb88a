"""Toxicity: marginals against all label sequences, held-out accuracy, spans, odd rows."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.toxicity_queries import op4_toxicity


def test_marginals_equal_the_sum_over_all_sequences():
    rng = np.random.default_rng(3)
    lengths = np.array([5, 1, 4, 0, 3])
    starts = np.cumsum(lengths) - lengths
    eu, steps = np.exp(rng.normal(0, 1.5, lengths.sum())), rng.normal(0, 1, 4)
    forward, backward = toxicity.marginals(eu, starts, lengths, steps)
    t = np.exp(steps)
    for start, length in zip(starts, lengths):
        mass = np.zeros((length, 2))
        for tags in itertools.product((0, 1), repeat=length):
            w = np.prod([eu[start + i] for i in range(length) if tags[i]] or [1.0])
            w *= np.prod([t[2 * x + y] for x, y in zip(tags, tags[1:])] or [1.0])
            for i, tag in enumerate(tags):
                mass[i, tag] += w
        got = (forward * backward)[start:start + length]
        assert got == pytest.approx(mass[:, 1] / mass[:, 0] if length else [])


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = op4_toxicity(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    toxic = [r for r in rows if r.toxic]
    assert toxic and sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.05 * len(rows)


def test_odd_rows_and_spans(spark):
    docs = spark.createDataFrame([(i, f"é the w{i} {'awful' if i % 4 == 0 else 'nice'} thing x{i * 7}") for i in range(200)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")).unionByName(
        spark.createDataFrame([(9999, 1), (1, None)], "doc_id long, toxic int"))
    model = toxicity.train(docs, labels, F.lit(True))
    odd = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "é AWFUL!", 1.0), (3, "é AWFUL!", 1.0), (4, "nice " * 80000, 1.0)],
                                "doc_id long, text string, score double")
    out = toxicity.score(odd, model).orderBy("doc_id").collect()
    assert [r.predicted for r in out] == [0, 0, 1, 1, 0]
    assert [tuple(s) for s in out[2].spans] == [(2, 7)] and out[0].spans == []
    assert all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(odd.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        toxicity.train(docs, labels, F.lit(False))
