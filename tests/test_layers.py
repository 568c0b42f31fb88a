"""Bronze, silver and gold on hand-made rows."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from strata.operators import bronze, gold, silver
from tests.conftest import rows

AT = datetime(2024, 1, 1)


def test_audit_columns_keep_the_row_count(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    out = bronze.with_audit_columns(df, AT)
    assert out.count() == 2
    assert out.columns == ["id", "name", "ingestion_timestamp", "source_system", "source_file", "record_hash"]
    assert isinstance(out.schema["ingestion_timestamp"].dataType, T.TimestampType)
    assert rows(out, "source_system", "source_file") == [("unknown", ""), ("unknown", "")]
    assert bronze.audit_schema(df.schema).names == out.columns


def test_record_hash_ignores_column_order_and_tells_rows_apart(spark):
    df = spark.createDataFrame([("a", "b"), ("a|y=1:b", None), (None, "a"), ("a", None), ("", None), (None, None)],
                               "x string, y string")
    hashes = [r[0] for r in df.select(bronze.record_hash(df.schema)).collect()]
    assert len(set(hashes)) == 6
    turned = df.select("y", "x")
    assert [r[0] for r in turned.select(bronze.record_hash(turned.schema)).collect()] == hashes


def test_ingest_counts_with_the_write(spark, path):
    df = spark.range(25)
    audited, seen = bronze.ingest(df, AT, "app")
    audited.write.parquet(path)
    assert seen.get["records"] == 25


def test_trim_covers_unicode_space_and_leaves_null(spark):
    df = spark.createDataFrame([("  test  ", 1), ("　 x y\t\n", 2), (" \t ", 3), (None, 4)], "s string, n int")
    assert rows(silver.trim_strings(df)) == [(None, 4), ("", 3), ("test", 1), ("x y", 2)]


def test_deduplicate_keeps_last_or_first(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 3, "d"), (2, 1, "e")],
                               "id int, seq int, v string")
    assert rows(silver.deduplicate(df, ["id"], ["seq"]), "id", "v") == [(None, "d"), (1, "b"), (2, "e")]
    assert rows(silver.deduplicate(df, ["id"], ["seq"], "first"), "id", "v") == [(None, "c"), (1, "a"), (2, "e")]
    with pytest.raises(ValueError):
        silver.deduplicate(df, ["id"], ["seq"], "any")
    with pytest.raises(ValueError):
        silver.deduplicate(df, [], ["seq"])


def test_deduplicate_repeated_batch(spark):
    events = [(1, "event1", 1735100000, 100.0), (2, "event2", 1735100060, 200.0), (3, "event3", 1735100120, 300.0)]
    df = spark.createDataFrame(events * 2, "id long, name string, timestamp long, value double")
    assert silver.deduplicate(df, ["id"], ["timestamp"]).count() == 3


def test_without_existing_compares_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    target = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    assert rows(silver.without_existing(df, target, ["id"])) == [(1,)]


def test_conform_rejects_bad_types_and_missing_values(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), True),
                           T.StructField("extra", T.StringType(), True)])
    df = spark.createDataFrame([("1", "a"), ("not_a_number", "b"), (None, "c")], "id string, name string")
    valid, rejected = silver.conform(df, schema)
    assert rows(valid) == [(1, "a", None)]
    assert rows(rejected) == [(None, "c", ["id is required"]), ("not_a_number", "b", ["id is not bigint"])]
    needed = T.StructType([T.StructField("key", T.LongType(), False)])
    assert silver.conform(df, needed)[1].select("conform_errors").first()[0] == ["key is missing"]


def test_conform_rejects_casts_that_change_a_value(spark):
    df = spark.createDataFrame([(1.0, "2024-01-02", "1.50", "2024-01-02", 300), (1.9, "2024", "1.239", "2024-01-02 10:00", 7)],
                               "n double, t string, d string, day string, small int")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.TimestampNTZType()),
                           T.StructField("d", T.DecimalType(10, 2)), T.StructField("day", T.DateType()), T.StructField("small", T.ByteType())])
    valid, rejected = silver.conform(df, schema)
    assert valid.count() == 0
    errors = {r.n: r.conform_errors for r in rejected.collect()}
    assert errors[1.0] == ["small is not tinyint"]
    assert errors[1.9] == ["n is not int", "t is not timestamp_ntz", "d is not decimal(10,2)", "day is not date"]


def test_landing_appends_and_counts(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    assert bronze.land(df, path, datetime(2024, 1, 1), "s") == 2 and bronze.land(df.limit(1), path, datetime(2024, 1, 2)) == 1
    assert rows(spark.read.parquet(path), "id", "source_system") == [(1, "s"), (1, "unknown"), (2, "s")]
    assert bronze.land(df, f"{path}-raw", add_metadata=False) == 2
    assert spark.read.parquet(f"{path}-raw").columns == ["id", "name"]
    with pytest.raises(ValueError):
        bronze.land(df, path)


def test_standardize(spark):
    df = spark.createDataFrame([(" ab ", "X y", "2024-01-31", 100.0), (None, None, "31.1.2024", None)],
                               "a string, b string, d string, cents double")
    good, bad = silver.standardize(df, {"a": "upper", "b": "title", "d": "date", "cents": "scale:0.01"})
    assert rows(good) == [("AB", "X Y", date(2024, 1, 31), 1.0)]
    assert rows(bad) == [(None, None, "31.1.2024", None, ["d is no date"])]
    with pytest.raises(ValueError):
        silver.standardize(df, {"a": "backwards"})


def test_bronze_to_silver_trims_before_it_deduplicates(spark):
    df = spark.createDataFrame([(" a ", 1), ("a", 2), ("b", 1)], "k string, seq int")
    out, rejected = silver.bronze_to_silver(df, keys=["k"], order_by=["seq"])
    assert rows(out) == [("a", 2), ("b", 1)] and rejected is None
    assert silver.bronze_to_silver(df)[0].count() == 3


def test_aggregate_null_keys_and_sums(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None), ("b", None), (None, 5.0)],
                               "k string, v double")
    assert rows(gold.aggregate(df, ["k"], {"v": "sum"})) == [("a", 1.0), ("b", 0.0)]
    assert rows(gold.aggregate(df, ["k"], {"v": "count"})) == [("a", 1), ("b", 0)]
    assert rows(gold.aggregate(df, ["k"], {"v": "mean"}, scale=2)) == [("a", 1.0), ("b", None)]
    with pytest.raises(ValueError, match="median"):
        gold.aggregate(df, ["k"], {"v": "median"})
    assert gold.aggregate(df.limit(0), ["k"], {"v": "sum"}).count() == 0


def test_metrics_evaluate_the_whole_expression(spark):
    df = spark.createDataFrame([("d1", 1000.0, 600.0), ("d2", 1500.0, 700.0)], "date string, revenue double, cost double")
    out = gold.metrics(df, {"total_revenue": "sum(revenue)", "total_cost": "sum(cost)",
                            "profit": "sum(revenue) - sum(cost)", "best": "max(revenue)"})
    assert out.first().asDict() == {"total_revenue": 2500.0, "total_cost": 1300.0, "profit": 1200.0, "best": 1500.0}
    for bad in ("reflect('java.lang.System', 'exit')", "revenue", "sum(revenue) + rand()"):
        with pytest.raises(ValueError):
            gold.metrics(df, {"m": bad})


def test_features_and_joins(spark):
    df = spark.createDataFrame([(1, 30, True)], "user_id int, age int, churned boolean")
    assert gold.ml_features(df, ["age"], "churned").columns == ["age", "churned"]
    dim = spark.createDataFrame([(1, "x")], "id int, name string")
    out = gold.denormalize(df.union(spark.createDataFrame([(2, 5, False)], df.schema)), (dim, "user_id", "id"))
    assert rows(out, "user_id", "name") == [(1, "x"), (2, None)]


def test_period_over_period(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 15.0), ("a", 3, 0.0), ("a", 4, 2.0)], "k string, p int, v double")
    out = gold.period_over_period(df, "p", "v", ["k"])
    assert rows(out, "p", "previous_v", "v_growth") == [(1, None, None), (2, 10.0, 0.5), (3, 15.0, -1.0), (4, 0.0, None)]


def test_exact_sums_do_not_depend_on_order(spark):
    df = spark.range(20000).select((F.col("id") % 100 / 100).alias("v"))
    totals = {df.repartition(n).agg(gold.exact_sum("v", 2)).first()[0] for n in (1, 3, 7)}
    assert totals == {9900.0}


@pytest.mark.parametrize("most", [1000, 1])
def test_dedupe_within_partitions_reads_only_those_that_come_in(spark, path, monkeypatch, most):
    monkeypatch.setattr(silver, "_VALUES", most)
    held = [(i, f"d{i % 5}") for i in range(20)] + [(None, "d1"), (7, None)]
    spark.createDataFrame(held, "id long, day string").write.partitionBy("day").parquet(path)
    fresh = spark.createDataFrame([(1, "d1"), (1, "d2"), (None, "d1"), (7, None), (8, None), (50, "d2")], "id long, day string")
    out = silver.without_existing(fresh, spark.read.parquet(path), ["id"], ["day"])
    assert rows(out) == [(1, "d2"), (8, None), (50, "d2")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*d1", plan)
    few = silver.without_existing(fresh.filter("day = 'd2'"), spark.read.parquet(path), ["id"], ["day"])
    assert rows(few) == [(1, "d2"), (50, "d2")]
    assert rows(silver.without_existing(fresh.limit(0), spark.read.parquet(path), ["id"], ["day"])) == []


def test_dedupe_within_times_holds_in_any_zone(spark):
    frame = spark.createDataFrame([(1, datetime(2024, 3, 31, 2, 30)), (2, None)], "id long, at timestamp")
    plain = frame.withColumn("at", F.col("at").cast("timestamp_ntz"))
    for held in (frame, plain):
        assert silver.without_existing(held, held, ["id"], ["at"]).isEmpty()
        assert held.where(silver.may_hold(held, ["at"])).count() == 2
