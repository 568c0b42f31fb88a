"""Jaccard join against a brute-force comparison of all pairs; components against union-find."""

from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from strata.cluster import checkpointed
from strata.llm import components as rounds, jaccard
from strata.llm.components import components
from strata.llm.jaccard_queries import op10_ngram_jaccard_join


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = roots(ids, pairs)
    return {i: (len(sets[i]), root[i]) for i in ids}


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], "doc_id long, text string, node int, shard string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs.repartition(3)).collect()}
    assert got == brute(texts)


def families(rng, sizes, edits):
    words = ["w%d" % i for i in range(400)]
    out, n = {}, 0
    shared = rng.choices(words, k=40)
    for size in sizes:
        base = rng.choices(words, k=rng.randrange(30, 120))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out[n] = " ".join(copy + (shared if rng.random() < 0.3 else []))
            n += 1
    return out


@pytest.mark.parametrize("pairs_of_token", [0, 4096])
def test_families_equal_brute_force(spark, monkeypatch, pairs_of_token):
    monkeypatch.setattr(jaccard, "_PAIRS_OF_TOKEN", pairs_of_token)
    monkeypatch.setattr(jaccard, "_FEW", 12 if pairs_of_token else 2)
    monkeypatch.setattr(jaccard, "_BLOCK", 256 if pairs_of_token else 7)
    texts = families(random.Random(5), [40, 7, 2, 2, 1, 1, 30], 4)
    texts |= {1000: None, 1001: "", 1002: " \n", 1003: "a b", 1004: "A  b", 1005: "a b c d e", 1006: "x " * 60000,
              1007: "x x x x x x", 1008: "ö Ö"}
    check(spark, texts)


def test_hot_tokens_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_HOT", 3)
    monkeypatch.setattr(jaccard, "_BLOCK", 7)
    # A family that reaches one Python call whole would have more nodes than its two blocks may hold.
    compare = jaccard._compare_blocks

    def bounded(rows):
        assert rows.num_rows <= 60
        return compare(rows)

    monkeypatch.setattr(jaccard, "_compare_blocks", bounded)
    shared = " ".join(f"s{i}" for i in range(40))  # three quarters of a text, and a unique rest
    texts = {500 + i: shared + " " + " ".join(f"u{i}x{j}" for j in range(14)) for i in range(150)}
    texts |= families(random.Random(6), [30, 7, 2, 1], 4)
    texts |= {700: texts[500] + " end", 701: texts[510] + " end"}
    check(spark, texts)


def test_families_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_BLOCK", 16)
    label = {n: n for n in range(600)} | {n: -1 for n in range(600, 900)} | {n: -2 - n % 7 for n in range(900, 950)}
    members = spark.createDataFrame([(5, n, k) for n, k in label.items()] + [(6, n, 1) for n in range(40)],
                                    "family long, node long, label long")
    placed, pairs = jaccard._in_blocks(members)
    blocks = {}
    for r in placed.collect():
        blocks.setdefault((r.family, r.block), []).append(r.node)
    assert max(map(len, blocks.values())) <= 64 and sum(map(len, blocks.values())) == 990
    pairs = [tuple(r) for r in pairs.collect()]
    assert len(set(pairs)) == len(pairs) and all(f == 5 for f, _, _ in pairs)
    met = {frozenset((a, b)) for f, low, high in pairs for a in blocks[f, low] for b in blocks[f, high] if a != b}
    assert all(frozenset((a, b)) in met for a in label for b in label if label[a] != label[b])


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op10_ngram_jaccard_join(spark, sf).collect()}
    assert got == brute(texts)


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(empty).collect() == []
    twice = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "q r s t u v")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard.join(twice).collect()) == [(0, 0), (5, 5), (5, 5)]


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    pairs += [(300, i) for i in range(301, 350)] + [(7, 7), (500, 500), (41, 40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == roots(sorted({n for p in pairs for n in p}), pairs)
    assert components(spark.createDataFrame([(None, 1)], "a long, b long")).collect() == []


def test_components_end_with_the_round_that_finds_them(spark, monkeypatch):
    """A round more, to see that nothing changes, costs the driver as many stages as any other."""
    made = []
    monkeypatch.setattr(rounds, "checkpointed", lambda df: made.append(1) or checkpointed(df))
    path = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (201, 200), (None, 3), (300, 299)]
    stars = [(1, i) for i in range(2, 9)] + [(20, 21)]
    for links, most in ((path, 8), (stars, 1), ([], 1)):
        made.clear()
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        ends = [(a, b) for a, b in links if a is not None]
        root = {n: n for pair in ends for n in pair}
        for _ in root:
            for a, b in ends:
                root[a] = root[b] = min(root[a], root[b])
        assert got == root and len(made) <= most, (len(made), most)


def test_last_plan_of_near_copies_is_small(spark):
    """What is known of the components is stored first: the driver watches over few stages at once."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50)
    plan = corpus_pipeline.drop_near_copies(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 4, plan.count("Exchange")
