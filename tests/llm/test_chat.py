"""Chat events folded and rendered, against a plain replay of the log."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strata.llm.chat import escape, fold, read_back, render, unescape
from strata.llm.chat_queries import _SQL, as_events, op1_chat_formatting
from tests.oracle import duck

SCHEMA = "conv_id long, seq long, turn long, kind string, role string, text string"


def replay(events):
    """The same rules, one event after the other."""
    said = {}
    for conv, _, turn, kind, role, text in sorted(events, key=lambda e: (e[0], e[1], e[2], e[3], e[4] or "", e[5] or "")):
        turns = said.setdefault(conv, {})
        if kind == "regenerate":
            for later in [t for t in turns if t > turn]:
                del turns[later]
        at = turns.setdefault(turn, ["", ""])
        at[0] = role if role is not None else at[0]
        at[1] = at[1] + (text or "") if kind == "delta" else text or ""
    return {(c, t): tuple(v) for c, turns in said.items() for t, v in turns.items()}


def test_fold_equals_replay(spark):
    rng = random.Random(1)
    events = [(rng.randrange(6), seq, rng.randrange(5), rng.choices(["message", "delta", "edit", "regenerate"], [3, 8, 1, 1])[0],
               rng.choice([None, "user", "assistant"]), rng.choice([None, "", "a", "b<s>", "ü"])) for seq in range(300)]
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in fold(spark.createDataFrame(events, SCHEMA)).collect()}
    assert got == replay(events)


def test_logs_of_the_query_end_in_its_rows(spark):
    rng = random.Random(3)
    rows = [(conv, rng.choice([None, *range(9)]), rng.choice([None, "user", "assistant"]),
             rng.choice([None, "", "a", "hello <s> wörld", "y" * 50])) for conv in range(5) for _ in range(conv * 3)]
    log = [tuple(r) for r in as_events(spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string")).collect()]
    assert {e[3] for e in log} == {"message", "delta", "edit", "regenerate"}
    want = {}
    for conv, _, role, text in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r)):
        want[conv, sum(c == conv for c, _ in want) + 1] = (role or "", text or "")
    assert replay(log) == want
    got = fold(spark.createDataFrame(log, SCHEMA).orderBy(F.rand(1))).collect()
    assert {(r.conv_id, r.turn): (r.role, r.text) for r in got} == want


def test_unknown_kind_raises(spark):
    with pytest.raises(Exception, match="unknown kind"):
        fold(spark.createDataFrame([(1, 1, 1, "poke", "user", "x")], SCHEMA)).collect()


def test_empty_and_null_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fold(empty).count() == 0 and render(fold(empty)).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None, None, 5), (None, None, None, None, None, None, 5)],
                                SCHEMA + ", place int")
    assert [tuple(r) for r in fold(odd).collect()] == [(None, None, "", "")]
    assert render(fold(odd)).select(read_back(F.col("formatted")).alias("t")).first().t[0].text == ""


def test_escape_is_reversible_and_leaves_no_control(spark):
    rng = random.Random(2)
    bits = ["<", "s>", "/s>", "[", "INST]", "/INST]", "\\", "<<SYS>>", "<|im_end|>", "<|im_start|>", "|", "\n", "x", "é"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(800)]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    for r in out:
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_start|>"))


def test_render_round_trip_and_spans(spark):
    rows = [(1, 0, "user", "hi <|im_end|>\n"), (1, 1, "assistant", "\\<s>"), (1, 2, "a b\n%", ""), (1, 3, "assistant", "ü" * 9),
            (2, 0, "assistant", None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie")]
    out = render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumn(
        "turns", read_back(F.col("formatted"))).collect()
    by = {r.conv_id: r for r in out}
    assert [tuple(t) for t in by[1].turns] == [(r, t) for c, _, r, t in rows if c == 1]
    assert [t.text for t in by[2].turns] == ["", "tie", "tie"]
    for r in out:
        for turn, span in zip(r.turns, r.spans):
            cut = r.formatted[span.start:span.start + span.length]
            assert span.loss == (turn.role == "assistant")
            assert cut.replace("<\\s>", "<s>").replace("<\\|", "<|") == turn.text or "\\" in turn.text


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = op1_chat_formatting(spark, sf)
    want = duck(sf).sql(_SQL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
