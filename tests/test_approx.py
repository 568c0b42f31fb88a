"""Approximate answers within their stated error of the exact ones, from sketches that are stored and joined."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import sketches
from strata.plans import QUERIES


def test_approximate_answers_are_near_the_exact_ones(spark, sf):
    users = QUERIES["gold_unique_users_approx"](spark, sf)
    assert users.count() == QUERIES["gold_unique_users"](spark, sf).count() and users.filter("not within").count() == 0
    lines = QUERIES["sql_approx"](spark, sf).collect()
    assert len(lines) == 3 and all(r.orders_within and r.median_within for r in lines)


def test_no_distinct_beside_sketches_and_no_exact_percentile(spark, sf):
    for key in ("sql_approx", "gold_unique_users_approx", "gold_unique_users_range"):
        plan = QUERIES[key](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "percentile" not in plan
        for line in plan.splitlines():
            assert not ("sketch" in line and "distinct" in line), key


def test_ranges_of_stored_sketches(spark, tmp_path):
    n = 40_000
    rows = spark.range(n).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 40 * 86400).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("g"),
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7919) % 9000).alias("user"), (F.col("id") % 1000).alias("v"))
    path = str(tmp_path / "s")
    sketches.daily(rows, "ts", {"users": F.col("user")}, {"vs": F.col("v")}, ["g"]).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 80
    some = stored.where("period < timestamp_ntz '2024-01-11'")
    got = {r.g: r for r in sketches.merged(some, ["g"], ["users"], ["vs"]).select(
        "g", "rows", sketches.distinct_count("users").alias("users"), sketches.quantile("vs", 0.5).alias("quantile")).collect()}
    exact = rows.where("ts < timestamp_ntz '2024-01-11'")
    for r in exact.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("user").alias("users")).collect():
        assert got[r.g].rows == r.n and abs(got[r.g].users - r.users) <= 0.05 * r.users
    near = spark.createDataFrame([(k, v["quantile"]) for k, v in got.items()], "g string, quantile double")
    assert all(r.rank_error <= 0.015 for r in sketches.rank_error(exact, "v", near, ["g"], 0.5).collect())
    off = near.withColumn("quantile", F.lit(900.0))
    assert all(abs(r.rank_error - 0.42) < 0.02 for r in sketches.rank_error(exact, "v", off, ["g"], 0.5).collect())
    assert sketches.merged(stored.limit(0), ["g"], ["users"], ["vs"]).collect() == []
