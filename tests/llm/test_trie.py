"""The trie of rebuilt conversations against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import trie as module
from strata.llm.trie import Heads, nodes_of, rebuilt_prefixes, standard_heads, trie, turn_references

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    said = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (
            r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        said[c].append((role or "", text or ""))
    whole = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(said.get(c - int(c - 5 * int(c / 5)), [])[:h] + said[c][h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)

    def below(node):
        leaves, saved = int(not children[node]), (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for child in children[node]:
            more = below(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for node, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(node))))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), *below(node),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(seed, convs=60, most=14):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 200), convs):
        for turn in range(rng.randint(0, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é世"])))
    return rows


@pytest.mark.parametrize("seed,run", [(0, 4096), (1, 3), (2, 1)])
def test_random_conversations(spark, monkeypatch, seed, run):
    monkeypatch.setattr(module, "RUN", run)
    monkeypatch.setattr(module, "ENDS_AT_ONCE", 4096 if seed == 0 else 7)
    rows = made(seed)
    assert got(trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_nulls_repeats_one_large_group_and_clashing_columns(spark):
    rows = [(c, t, "user", "same") for c in range(0, 300, 5) for t in range(3)]
    rows += [(c, t, "user", "same") for c in range(1, 60, 5) for t in range(12)]
    rows += [(1000, None, None, None), (1000, None, None, None), (1000, 0, "", "x"), (1001, None, "user", None), (None, 0, "user", "?"),
             (1004, 2, "u", "long " * 50000), (1004, 2, "u", "long " * 50000), (7, -5, "a", "b:"), (7, -4, "a:", "b")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, ref string")
    assert got(trie(df)) == brute(rows)


def test_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(module, "RUN", 64)
    rows = [(5, t, "user", str(t % 7)) for t in range(700)] + [(6, t, "user", str(t % 7)) for t in range(350)]
    assert got(trie(spark.createDataFrame(rows, SCHEMA))) == brute_long(rows)


def brute_long(rows):
    import sys

    old = sys.getrecursionlimit()
    sys.setrecursionlimit(10000)
    try:
        return brute(rows)
    finally:
        sys.setrecursionlimit(old)


def test_empty_table_and_bases_that_are_absent(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(c, t, "user", f"{t}") for c in (11, 12, 13, 14, 16) for t in range(3)]
    assert got(trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_fingerprints_that_collide_are_found_out(spark, monkeypatch):
    rows = spark.createDataFrame([(0, 0, "user", "a"), (5, 0, "user", "b")], SCHEMA)
    prefixes = rebuilt_prefixes(turn_references(rows), Heads(F.col("conv_id"), F.lit(0).cast("long"), 8))
    assert nodes_of(prefixes).count() == 3
    with pytest.raises(Exception, match="one fingerprint"):
        nodes_of(prefixes.withColumns({f"f{k}": F.lit(1).cast("long") for k in range(4)}).where("depth = 1")).collect()


def test_no_texts_are_shuffled(spark, sf):
    turns = turn_references(spark.read.parquet(f"{sf}/conversations.parquet"))
    plan = turns._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line or "Sort [" in line:
            assert "text" not in line
    assert standard_heads().most == 8
