"""Token counts that follow edits, against counting the edited texts anew."""

from __future__ import annotations

import random

import pytest

from strata.llm import tokencount
from strata.llm.tokencount import Tree, _counter, _ranks, apply, build, edit, with_edits
from strata.llm.tokencount_queries import INSERTED, edits_of, files, op2_token_counts
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def count():
    ranks, pattern = files()
    return _counter(_ranks(ranks), pattern)


def sums_hold(tree):
    return all(s[i] == s[2 * i] + s[2 * i + 1] for s in (tree.chars, tree.tokens) for i in range(1, tree.width))


@pytest.mark.parametrize("leaf", [4, 20, 512])
def test_edits_equal_a_new_count(count, monkeypatch, leaf):
    monkeypatch.setattr(tokencount, "LEAF", leaf)
    rng = random.Random(leaf)
    bits = ["the", " cat", "  ", "\n", "'s", "'", "12", " ü", "é", "!!", " ", "\t ", "世", " 😀", "don't", "x" * 30, "\x1c", " "]
    for _ in range(60):
        text = "".join(rng.choices(bits, k=rng.randrange(60)))
        tree = Tree.of(text, count)
        for _ in range(25):
            start, removed = rng.randrange(-2, len(text) + 3), rng.choice([0, 1, 3, 40])
            inserted = "".join(rng.choices(bits, k=rng.choice([0, 1, 2, 25])))
            low = min(max(0, start), len(text))
            want = text[:low] + inserted + text[min(len(text), low + removed):]
            text, tree, _ = edit(text, tree, start, removed, inserted, count)
            assert text == want
            assert (tree.tokens[1], tree.chars[1]) == (count(text), len(text)) and sums_hold(tree)


def test_an_edit_encodes_its_surroundings_only(count):
    text = "some words here and there, " * 20_000
    tree = Tree.of(text, count)
    text, tree, encoded = edit(text, tree, 300_000, 5, "word", count)
    assert encoded < 4 * tokencount.LEAF and tree.tokens[1] == count(text)


def test_query_equals_a_new_count(spark, count):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    edits = {r.doc_id: r for r in docs.select("doc_id", "text", edits_of(F.col("text"), F.col("doc_id")).alias("e")).collect()}
    rows = op2_token_counts(spark, sf).collect()
    assert len(rows) == len(edits)
    for r in rows:
        text = edits[r.doc_id].text
        assert r.n_tokens == count(text)
        for e in edits[r.doc_id].e:
            text = text[:e.start] + e.inserted + text[e.start + e.removed:]
        assert (r.n_tokens_edited, r.n_chars_edited) == (count(text), len(text))


def test_odd_rows_and_joined_edits(spark, count):
    ranks, pattern = files()
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x" * 100_000, "c"), (4, "a b", "d"), (4, "a b", "d"), (None, "q", "e")],
                                 "doc_id long, text string, tree string")
    edits = spark.createDataFrame([(1, 1, 0, 0, "new"), (4, 2, 0, 1, "z"), (4, 1, 9, None, " end"), (4, 3, None, None, None), (99, 1, 0, 0, "x")],
                                  "doc_id long, seq int, start int, removed int, inserted string")
    out = apply(with_edits(build(docs, ranks, pattern), edits), "edits", ranks, pattern).collect()
    got = sorted((r.doc_id or 0, r.text, r.n_tokens) for r in out)
    texts = [(0, "q"), (1, "new"), (2, ""), (3, "x" * 100_000), (4, "z b end"), (4, "z b end")]
    assert got == [(i, t, count(t)) for i, t in texts]
    assert build(docs.limit(0), ranks, pattern).collect() == []
    assert len(INSERTED) == 5


def test_rank_files_of_one_length_have_counters_of_their_own():
    import base64

    def ranks(*more):
        tokens = [bytes([i]) for i in range(256)] + list(more)
        return b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))

    first, second = ranks(b"ab"), ranks(b"cd")
    assert len(first) == len(second)
    assert [_counter(r, r"\w+")("abcd") for r in (first, second, ranks(b"ab", b"cd"))] == [3, 3, 2]
    assert [_counter(r, r"\w+")("abab") for r in (first, second)] == [2, 4]
