"""Language ID: gradient against differences, held-out accuracy, defined results for odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid
from strata.llm.langid_queries import op6_language_id
from strata.llm.registry import fold


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    params = {"bias": np.zeros(3, np.float32)}
    for side in "fb":
        params["in_" + side] = rng.normal(0, .5, (24, 256)).astype(np.float32)
        params["re_" + side] = rng.normal(0, .3, (24, 8)).astype(np.float32)
        params["out_" + side] = rng.normal(0, .3, (3, 8)).astype(np.float32)
    chars, labels = rng.integers(0, 5, (20, 7)), rng.integers(0, 3, 7)
    inside = np.ones((20, 7), bool)
    inside[12:, 3] = False
    _, grads = langid._gradients(params, chars, inside, labels)
    for name in params:
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        sides = []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in params.items()}
            moved[name][at] += sign * 0.01
            sides.append(langid._gradients(moved, chars, inside, labels)[0])
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 0.02, rel=0.02)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = op6_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and 0 <= r.share <= 1 for r in rows)


def test_odd_rows(spark):
    learn = spark.createDataFrame(
        [(i, t, l) for i in range(40) for t, l in (("the cat sat on that mat " * 9, "en"), ("der hund ist für uns " * 9, "de"))],
        "doc_id long, text string, lang string")
    model = langid.train(learn, F.lit(True))
    rows = [(1, None, "x", 9), (2, "", "x", 9), (3, "12 %% 34", "x", 9), (4, "the cat " * 90000, "x", 9), (4, "der hund ist", "x", 9)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, _said int")
    got = sorted((r.doc_id, r.lang_pred) for r in langid.identify(odd.drop("_said"), model).collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "en")]
    assert langid.identify(odd.drop("_said").limit(0), model).collect() == []
    with pytest.raises(ValueError):
        langid.train(learn, F.lit(False))


def test_fold_is_crc32_of_the_id(spark):
    import zlib
    rows = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("f", fold(4)).collect()
    assert all(r.f == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
