"""Language-model scores: exact unigram figures, the filter's one-sided error, and what the model prefers."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lm
from strata.llm.lm_queries import op8_lm_scoring


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(texts, held):
    counts = Counter(t for i, text in texts.items() if not held[i] for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    return {i: (held[i], len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
                sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens(t))) for i, t in texts.items()}


def test_query_equals_brute_force_and_beats_unigrams(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = brute(texts, {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts})
    rows = op8_lm_scoring(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_equal_blocks_stay_apart(spark, tmp_path):
    texts = {i: f"word{i} the cat {i * i} sat on" for i in range(300)}
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    rows = lm.score(docs.union(docs), F.lit(False)).collect()
    twice = brute(texts | {i + 1000: t for i, t in texts.items()}, dict.fromkeys([*texts, *(i + 1000 for i in texts)], False))
    assert sorted(r.doc_id for r in rows) == sorted([*texts] * 2)
    for r in rows:
        held, n, known, total, base = twice[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_filter_never_understates_and_seldom_overstates():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 40, 20_000).astype(np.uint64)
    counts = rng.zipf(1.6, 20_000).clip(0, 10_000)
    bits = lm.build_filter(hashes, counts)
    size = max(64, lm.BITS_PER_ENTRY * int(lm._entries(counts)))
    steps = lm.probe(bits, size, hashes)
    real = 1 + np.floor(np.log2(counts))
    assert (steps >= real).all() and (steps == real).mean() > 0.95
    strangers = lm.probe(bits, size, rng.integers(1 << 41, 1 << 42, 20_000).astype(np.uint64))
    assert (strangers > 0).mean() < 0.03
    assert (lm.probe(lm.build_filter(hashes[:0], counts[:0]), 64, hashes) == 0).all()


def test_segments_learn_only_from_texts_to_learn_from(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = [(i, "red fox ran") for i in range(20)] + [(100 + i, "blue owl slept") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    got = {r.doc_id: r for r in lm.score(docs, F.col("doc_id") >= 100).collect()}
    assert got[0].n_known == 4 and got[0].train_tokens == 80
    # Nothing of the held-out texts but their end is known, and no pair of theirs is found.
    assert got[100].n_known == 1 and got[100].score <= got[100].base_score + 1


def test_chances_after_contexts_add_up_on_average():
    rng = np.random.default_rng(1)
    words = 150
    pairs = np.minimum(rng.zipf(1.4, (words, words)), 3000) * (rng.random((words, words)) < 0.3)
    hashes = lm.mix(np.arange(words * words, dtype=np.uint64)) & np.uint64((1 << 40) - 1)
    flat = pairs.ravel()
    bits = lm.build_filter(hashes[flat > 0], flat[flat > 0])
    steps = lm.probe(bits, max(64, lm.BITS_PER_ENTRY * int(lm._entries(flat))), hashes)
    own, before = pairs.sum(axis=0).astype(float), pairs.sum(axis=1).astype(float)
    real = lm._steps_of(flat)
    known, total = np.bincount(real, minlength=64), np.bincount(real, flat, 64)
    counts = np.where(known > 0, total / np.maximum(known, 1), 0.0)
    totals = lm.Totals(int(own.sum()), words, 0.7, counts)
    sums = lm.chances(totals, steps, np.tile(own, words), np.repeat(before, words)).reshape(words, words).sum(axis=1)
    assert np.average(sums, weights=before) == pytest.approx(1, abs=0.02)
    assert np.abs(sums - 1).max() < 0.5 and (sums > 0).all()


def test_seen_pairs_are_likelier_and_odd_rows(spark, tmp_path):
    rows = [(i, "the cat sat on the mat") for i in range(50)] + [(100, "mat the on sat cat the"), (101, "the cat sat on the mat")]
    rows += [(102, None), (103, ""), (104, "Q " * 120_000), (105, "Q"), (105, "Q"), (None, "the")]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").write.parquet(path)
    docs = spark.read.parquet(path)
    got = [r for r in lm.score(docs, F.col("doc_id") >= 100).collect()]
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert by[101].score > by[100].score + 5 and by[101].base_score == pytest.approx(by[100].base_score)
    assert by[102].n_tokens == by[103].n_tokens == 1 and by[102].score == by[103].score
    assert by[104].n_tokens == 120_001 and by[104].n_known == 1 and by[None].held_out is False
    nothing = lm.score(docs, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in nothing)
    assert lm.score(docs.limit(0), F.lit(False)).collect() == []
