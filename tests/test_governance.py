"""Quality, lineage, protection, operational metrics and SQL."""

from __future__ import annotations

import base64
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from strata.functions.text import mask_pii, mask_pii_in_text
from strata.operators import bronze, lineage, opsmetrics, protect, quality
from strata.operators.quality import Rule
from strata.operators.query import register_table, sql_query
from tests.conftest import rows


# ---- quality

def test_suite_results(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "a", 500), (2, None, None)], "id int, s string, n int")
    rules = [Rule("not_null", "s", "critical"), Rule("unique", "id"), Rule("unique", "s"), Rule("range", "n", params={"low": 0, "high": 120}),
             Rule("pattern", "s", params={"regex": "^b"}), Rule("not_null", "gone")]
    out = quality.run_suite(df, rules, "silver", "people")
    assert rows(out, "check_type", "column_name", "passed", "failed_rows", "unique_values", "error") == [
        ("not_null", "gone", False, None, None, "column gone not found"), ("not_null", "s", False, 2, None, None),
        ("pattern", "s", False, 1, None, None), ("range", "n", False, 1, None, None),
        ("unique", "id", False, 1, 2, None), ("unique", "s", False, 1, 2, None)]
    assert {r["total_rows"] for r in out.collect()} == {3}


def test_suite_on_no_rows(spark):
    out = quality.run_suite(spark.createDataFrame([], "id int"), [Rule("not_null", "id"), Rule("unique", "id")])
    assert rows(out, "passed", "failed_rows") == [(True, 0), (True, 0)]


def test_one_null_is_unique_two_are_not(spark):
    one = spark.createDataFrame([(1,), (None,)], "id int")
    assert quality.run_suite(one, [Rule("unique", "id")]).first()["passed"]
    assert not quality.run_suite(one.union(one.filter("id IS NULL")), [Rule("unique", "id")]).first()["passed"]


def test_score_and_quarantine(spark):
    results = spark.createDataFrame([("l", "t", True, "critical"), ("l", "t", False, "low")], "layer string, table_name string, passed boolean, severity string")
    assert quality.score(results).first()["score"] == 50.0
    assert quality.score(results, weighted=True).first()["score"] == 80.0
    df = spark.createDataFrame([(1, "a"), (-1, None)], "n int, s string")
    good, bad = quality.quarantine(df, [Rule("range", "n", params={"low": 0}), Rule("not_null", "s", name="has s")])
    assert rows(good) == [(1, "a")] and rows(bad, "reasons") == [(["range:n", "has s"],)]
    with pytest.raises(ValueError):
        quality.quarantine(df, [Rule("unique", "n")])
    with pytest.raises(ValueError):
        Rule("sum", "n")


# ---- lineage

def test_impact_with_diamond_and_cycle(spark):
    edges = spark.createDataFrame([("b.x", "s.y"), ("b.x", "s.z"), ("s.y", "g.w"), ("s.z", "g.w"), ("g.w", "b.x"), ("b.q", "s.q")],
                                  "source string, target string")
    starts = spark.createDataFrame([("b.x",)], "n string")
    assert rows(lineage.impact(edges, starts), "node", "depth") == [("g.w", 2), ("s.y", 1), ("s.z", 1)]
    assert rows(lineage.impact(edges, starts, upstream=True), "node", "depth") == [("g.w", 1), ("s.y", 2), ("s.z", 2)]
    assert rows(lineage.impact(edges, starts, max_depth=1), "node") == [("s.y",), ("s.z",)]
    assert rows(lineage.graph_counts(edges)) == [("edges", 6), ("nodes:b", 2), ("nodes:g", 1), ("nodes:s", 3)]


def test_impact_follows_a_chain_longer_than_any_recursion_limit(spark):
    edges = spark.range(30).select(F.concat(F.lit("n."), "id").alias("source"), F.concat(F.lit("n."), F.col("id") + 1).alias("target"))
    starts = spark.createDataFrame([("n.0",)], "n string")
    assert lineage.impact(edges, starts).agg(F.max("depth")).first()[0] == 30


def test_edges_from_events(spark):
    one = lambda n: lineage.dataset(F.lit("ns"), F.lit(n))
    log = spark.range(5).select(lineage.run_event(F.lit("j"), F.array(one("a"), one("b")), F.array(one("c")), F.lit("t"), F.lit("r")).alias("value"))
    started = log.select(F.replace("value", F.lit("COMPLETE"), F.lit("START")).alias("value")).select(F.replace("value", F.lit('"a"'), F.lit('"z"')).alias("value"))
    assert rows(lineage.edges(log.union(started))) == [("ns.a", "ns.c"), ("ns.b", "ns.c")]


# ---- protection

@pytest.mark.parametrize("text, char, visible, want", [
    ("john.doe@example.com", "*", 3, "joh***@e***"), ("1234567890", "*", 4, "1234***7890"), ("abc", "*", 3, "***"),
    ("sensitive", "X", 2, "seXXXve"), ("a@b.c", "*", 3, "*****"), ("", "*", 3, ""), (None, "*", 3, None),
    ("one@two@three.com", "*", 3, "one***com"), ("username@", "*", 3, "use***me@"), ("secret", "*", 0, "***"),
])
def test_mask(spark, text, char, visible, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(mask_pii(F.col("s"), char, visible)).first()[0] == want


def test_mask_inside_text(spark):
    text = "mail jo.smith+x@mail.example.org, or ab@c.de; ssn 123-45-6789, call +1 (555) 123-4567 or 555.123.4567; not 12345"
    df = spark.createDataFrame([(text,), ("nothing here",), (None,)], "s string")
    got = [r[0] for r in df.select(mask_pii_in_text(F.col("s"))).collect()]
    assert got == ["mail jo.***@m***, or ab***@c***; ssn ***-**-****, call ***-***-**** or ***-***-****; not 12345", "nothing here", None]


def test_encryption_round_trip(spark):
    df = spark.createDataFrame([("secret",), (None,), ("",)], "s string")
    key = b"0123456789abcdef0123456789abcdef"
    keys = spark.createDataFrame([("k1", bytearray(key)), ("k2", bytearray(b"fedcba9876543210"))], protect.KEYS)
    stored = protect.encrypt_columns(df, ["s"], keys, "k1").union(protect.encrypt_columns(df, ["s"], keys, "k2"))
    assert "secret" not in str(stored.collect())
    back = protect.decrypt_columns(stored, ["s"], keys)
    assert rows(back) == [(None,), (None,), ("",), ("",), ("secret",), ("secret",)]
    for frame in (stored, back):
        plan = frame._jdf.queryExecution().toString()
        assert not any(k in plan for k in (key.decode(), base64.b64encode(key).decode(), key.hex(), key.hex().upper()))
    with pytest.raises(Exception, match="no key k3"):
        protect.encrypt_columns(df, ["s"], keys, "k3").collect()


def test_pseudonyms_join_and_salt_matters(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "s string")
    plain, salted = (protect.pseudonymize_columns(df, ["s"], s) for s in (None, "x"))
    assert plain.distinct().count() == 2 and rows(plain) != rows(salted) and rows(plain)[0] == (None,)


# ---- operational metrics and SQL

def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([("t", 0.003), ("t", 0.2), ("t", 99.0)], "topic string, s double")
    out = opsmetrics.latency_histogram(df, F.col("s"), ["topic"], (0.005, 0.5))
    assert rows(out, "le", "messages") == [(None, 3), (0.005, 1), (0.5, 2)]


def test_ingest_record_takes_the_count_of_the_write(spark, path):
    audited, seen = bronze.ingest(spark.range(7), datetime(2024, 1, 1))
    audited.write.parquet(path)
    assert opsmetrics.ingest_record(seen, "app", "bronze", "success", datetime(2024, 1, 1))["records"] == 7


def test_last_error_is_the_latest_failure(spark):
    runs = spark.createDataFrame([("j", "failed", 1, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), "old"),
                                  ("j", "failed", 2, datetime(2024, 1, 2), datetime(2024, 1, 2, 0, 2), "new"),
                                  ("j", "failed", 3, datetime(2024, 1, 3), None, None)],
                                 "job_name string, status string, run_id int, started_at timestamp, completed_at timestamp, error_message string")
    assert rows(opsmetrics.job_run_report(runs)) == [("j", "failed", 3, 180, 120, "new")]


def test_sql_binds_parameters_and_caps_rows(spark, path):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(150)], "id int, name string")
    assert sql_query(spark, "SELECT * FROM {t}", {"t": df}, limit=100).count() == 100
    assert sql_query(spark, "SELECT * FROM {t} WHERE id < :n", {"t": df}, {"n": 3}).count() == 3
    assert sql_query(spark, "SELECT * FROM {t} WHERE name = :n", {"t": df}, {"n": "x' OR '1'='1"}).count() == 0
    assert sql_query(spark, "SELECT * FROM {t}", {"t": df}).count() == 150
    df.write.parquet(path)
    register_table(spark, "silver.people", path)
    try:
        assert sql_query(spark, "SELECT count(*) AS n FROM silver.people").first()["n"] == 150
    finally:
        spark.sql("DROP TABLE silver.people")
        spark.sql("DROP DATABASE silver")


def test_rules_from_text_and_configuration(spark):
    parsed = Rule.parse("range:age:0:120")
    assert (parsed.check, parsed.column, parsed.params) == ("range", "age", {"low": 0.0, "high": 120.0})
    assert Rule.parse("range:age::9").params == {"high": 9.0} and Rule.parse("pattern:c:^a:b$").params == {"regex": "^a:b$"}
    for text in ("not_null", "range:age", "poke:age", "unique:a:b", "pattern:c"):
        with pytest.raises(ValueError):
            Rule.parse(text)
    df = spark.createDataFrame([(1, 30.0), (None, 200.0), (1, 1.5)], "id int, age double")
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("age", T.IntegerType())])
    rules = quality.rules_from([{"name": "no_null_ids", "rule": "not_null:id", "severity": "critical"}, {"rule": "unique:id"},
                                {"rule": "range:age:0:120"}, {"name": "schema_conformance", "severity": "critical"}], schema)
    got = {r.check_name: r.failed_rows for r in quality.run_suite(df, rules).collect()}
    assert got == {"no_null_ids": 1, "unique:id": 1, "range:age": 1, "schema_conformance": 2}
    with pytest.raises(ValueError):
        quality.rules_from([{"name": "schema_conformance"}])
