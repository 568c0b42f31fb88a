"""Benchmark passages against a brute-force search of all windows."""

from __future__ import annotations

import random
import re
from collections import Counter

from strata.llm import decontaminate
from strata.llm.decontaminate_queries import op7_benchmark_decontamination


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def bag(ws):
    size = min(5, len(ws))
    return Counter(tuple(ws[i:i + size]) for i in range(len(ws) - size + 1))


def best(doc, item):
    ws, n, own = words(doc), len(words(item)), bag(words(item))
    if not ws or not n:
        return 0.0
    if len(ws) < min(5, n):
        return 0.0
    top = 0.0
    for i in range(max(1, len(ws) - n + 1)):
        window = bag(ws[i:i + n])
        both = sum((window & own).values())
        top = max(top, both / (sum(window.values()) + sum(own.values()) - both))
    return top


def expected(docs, items):
    return {(d, i): round(b, 9) for d, text in docs.items() for i, item in items.items() if (b := best(text, item)) >= 0.75}


def test_planted_variants_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = ["w%d" % i for i in range(300)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.randrange(6, 45))) for i in range(25)}
    items |= {100: "one two", 101: "", 102: "solo"}
    docs = {}
    for d in range(150):
        text = words(items[rng.randrange(25)])
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        around = [rng.choices(vocabulary, k=rng.randrange(30)) for _ in range(2)]
        docs[d] = ", ".join(around[0] + text + around[1]).upper()
    docs |= {500: None, 501: "", 502: "!!", 503: "One, TWO three", 504: "x solo", 505: items[3] + " gap " + items[4]}
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs.items()], "doc_id long, text string, item int")
    bench = spark.createDataFrame([*items.items(), (900, None)], "item_id long, text string")
    for per_pass in (20_000, 10):
        monkeypatch.setattr(decontaminate, "ITEMS_PER_PASS", per_pass)
        out = decontaminate.find(frame, bench).collect()
        assert {(r.doc_id, h.item): round(h.similarity, 9) for r in out for h in r.leaks} == expected(docs, items)
    kept = {r.doc_id for r in decontaminate.clean(frame, bench).collect()}
    assert kept == set(docs) - {d for d, _ in expected(docs, items)}
    hit = next(r for r in out if r.doc_id == 505).leaks
    assert {docs[505][h.start:h.end] for h in hit if h.similarity == 1} == {items[3], items[4]}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in op7_benchmark_decontamination(spark, sf).collect()}
    assert got == expected(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(docs, none).count() == 1
    assert decontaminate.find(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).collect() == []


def test_an_id_with_several_texts_is_found_once_in_any_number_of_passes(spark, monkeypatch):
    one, two = ("alpha beta gamma delta epsilon zeta eta theta", "ein zwei drei vier sechs sieben acht neun")
    docs = spark.createDataFrame([(1, f"x {one} y {two} z"), (2, two)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, one), (7, two), (8, two)], "item_id long, text string")
    said = []
    for per_pass in (1, 2, 20_000):
        monkeypatch.setattr(decontaminate, "ITEMS_PER_PASS", per_pass)
        out = decontaminate.find(docs, bench).collect()
        said.append(sorted((r.doc_id, sorted((h.item, h.start, h.end) for h in r.leaks)) for r in out))
        assert [len(x) for _, x in said[-1]] == [2, 2]
    assert said[0] == said[1] == said[2]
