"""Quality rules: counts against a plain reading of each text, verdicts against labels held out."""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from strata.llm.registry import fold
from strata.llm.rules import KEEP_FROM, apply, train
from strata.llm.rules_queries import op12_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t ", "one", "a b c d e f g h a b c d e f g h", "x\n" * 40, "A a\nA a\na a\n\nA a\r\nA a", "é ü 世界 " * 9,
       "w " * 60000, "#*$%&|<>" * 5 + " \x0b\x0c x", "one two three four five six seven eight nine\n" * 2 + "tail " * 3,
       "line without end\nline without end", "\n\n\nq\n\nq", "a\x1cb a\x85b c", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8", "\nq", "q\n"]


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in lines.values()),
            len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def _got(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_counts_of_odd_texts_clashing_columns_and_no_model(spark):
    data = [(i % 3, t, "s", 7) for i, t in enumerate(ODD)] * 2
    docs = spark.createDataFrame(data, "doc_id long, text string, score string, kept int").coalesce(1)
    out = apply(docs, None).collect()
    assert sorted((r.text or "", _got(r)) for r in out) == sorted((t or "", counts(t)) for _, t, *_ in data)
    assert all(r.score is None and r.kept == (not r.base_failed) for r in out)


def test_query_counts_every_text_and_tells_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r.doc_id: r for r in op12_quality_rules(spark, sf).collect()}
    assert out.keys() == docs.keys()
    for i, r in out.items():
        assert _got(r) == counts(docs[i]), i
        assert r.kept == (not r.base_failed and r.score >= KEEP_FROM)
    held = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
            if r.doc_id in out and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    good = [out[r.doc_id].kept or out[r.doc_id].base_failed for r in held if r.quality == 1]
    bad = [not out[r.doc_id].kept for r in held if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) >= 0.9 * len(bad), (sum(good), len(good), sum(bad), len(bad))


def test_labels_that_teach_nothing_and_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert train(docs, labels.limit(0), ~fold(4)) is None
    assert train(docs, labels.withColumn("quality", F.lit(None).cast("int")), ~fold(4)) is None
    assert train(docs.limit(0), labels, ~fold(4)) is None
    model = train(docs, labels.where("quality = 1"), ~fold(4))
    assert apply(docs.limit(0), model).collect() == []
    assert all(r.kept == (not r.base_failed) for r in apply(docs, model).collect())
