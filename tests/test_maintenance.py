"""Upkeep of tables: only what must be touched changes, and the layout stays."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata.plans.registry import ntz
from strata.sources import maintenance, tables
from tests.conftest import rows

DAYS = [("ts", "day"), ("kind", "identity")]


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.fixture
def table(spark, path):
    df = spark.range(4000).select(
        "id", (F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 10 * 86400 + F.col("id")).cast("timestamp_ntz")).alias("ts"),
        F.when(F.col("id") % 3 == 0, "a b:c").otherwise("x").alias("kind"), (F.col("id") * 37 % 4001).alias("v"))
    tables.write(df, path, DAYS)
    return df


def test_delete_touches_only_directories_with_a_match(spark, table, path):
    before = files(path)
    gone = "ts < timestamp_ntz '2024-01-02' AND kind = 'a b:c' OR id = 7"
    assert maintenance.delete_where(spark, path, gone, DAYS) == 2
    after = files(path)
    assert len(before - after) == 2 and len(after - before) == 1  # one directory has no row left
    left = spark.read.parquet(path)
    assert rows(left, "id", "v") == rows(table.where(f"NOT ({gone})"), "id", "v")
    assert set(left.columns) == {"id", "ts", "kind", "v", "ts_day", "kind_identity"}
    plan = left.where("ts_day = '2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "ts_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert maintenance.delete_where(spark, path, "v < 0", DAYS) == 0
    assert maintenance.delete_where(spark, path, "CAST(NULL AS BOOLEAN)", DAYS) == 0 and files(path) == after


def test_retention_drops_directories(spark, table, path):
    before = files(path)
    oldest = ntz("2024-01-05 00:30:00")
    assert maintenance.purge_before(spark, path, "ts", oldest, DAYS) == 8
    assert rows(spark.read.parquet(path), "id") == rows(table.where(F.col("ts") >= oldest), "id")
    assert {f for f in before if "ts_day=2024-01-05" > f[:17]} & files(path) == set()
    assert {f for f in before if f[:17] > "ts_day=2024-01-05"} <= files(path)
    with pytest.raises(ValueError):
        maintenance.purge_before(spark, path, "other", oldest, DAYS)


def test_compaction_packs_small_files_only(spark, path):
    spec = [("k", "identity")]
    big = spark.range(60_000).select("id", (F.xxhash64("id")).alias("x"), (F.xxhash64("id", F.lit(1))).alias("y"), F.lit("p q").alias("k"))
    tables.write(big.coalesce(1), path, spec)
    large = files(path)
    for turn in range(4):
        more = big.where(f"id % 20 = {turn}").withColumn("id", F.col("id") + 10 ** 6).union(
            big.where(f"id % 20 = {turn}").withColumn("k", F.lit("r")) if turn == 0 else big.limit(0))
        tables.write(more, path, spec)
    everything, size = rows(spark.read.parquet(path), "id", "x", "y", "k"), os.path.getsize(os.path.join(path, min(large)))
    alone = {f for f in files(path) if "k_identity=r" in f}
    assert maintenance.compact(spark, path, spec, ["x", "y"], size // 8) == 4
    after = files(path)
    assert large | alone <= after and 2 <= len(after - large - alone) < 4
    assert rows(spark.read.parquet(path), "id", "x", "y", "k") == everything
    # A file holds a part of the curve: less than the whole range of at least one column.
    for f in after - large - alone:
        got = spark.read.parquet(os.path.join(path, f)).agg(*[((F.max(c) / 2.0 ** 64) - (F.min(c) / 2.0 ** 64)).alias(c) for c in "xy"]).first()
        assert min(got.x, got.y) < 0.9
    assert maintenance.compact(spark, path, spec, ["x", "y"], 1000) == 0 and files(path) == after
    assert not [d for d in os.listdir(path) if d.startswith("_") and d != "_SUCCESS"]


def test_a_compaction_that_was_cut_short_is_finished(spark, table, path, monkeypatch):
    tables.write(table.withColumn("id", F.col("id") + 5000), path, DAYS)
    whole = rows(spark.read.parquet(path), "id")
    calls = []
    real = maintenance._remove
    monkeypatch.setattr(maintenance, "_remove", lambda s, p: calls.append(p) if calls else (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        maintenance.compact(spark, path, DAYS, ["v"])
    monkeypatch.setattr(maintenance, "_remove", real)
    maintenance.finish_compaction(spark, path)
    assert rows(spark.read.parquet(path), "id") == whole
    tables.write(table.limit(10), f"{path}/{maintenance._PACKED}", DAYS)  # a job that ended before its list was written
    maintenance.finish_compaction(spark, path)
    assert rows(spark.read.parquet(path), "id") == whole and not os.path.exists(f"{path}/{maintenance._PACKED}")
