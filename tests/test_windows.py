"""Split windows, as-of and range joins against plain windows and brute force, with one key holding most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from strata.operators import joins, windows
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    made = []
    for i in range(1500):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        made.append((key, rng.choice([None, *range(60)]) if rng.random() < 0.9 else 7, i, rng.choice([None, 1, 2, 3])))
    return spark.createDataFrame(made, "k string, t int, id int, v int").cache()


def test_running_totals(spark, data):
    plain = Window.partitionBy("k").orderBy(F.asc_nulls_first("t"), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = data.withColumns({"total": F.sum("v").over(plain), "n": F.count(F.lit(1)).over(plain)})
    got = windows.running(data, ["k"], ["t", "id"], F.floor(F.col("t") / 10), {"total": F.col("v"), "n": F.lit(1)})
    assert rows(got, "id", "total", "n") == rows(want, "id", "total", "n")


@pytest.mark.parametrize("descending", [False, True])
def test_ranks(spark, data, descending):
    order = F.desc_nulls_last("t") if descending else F.asc_nulls_first("t")
    by_value, whole = Window.partitionBy("k").orderBy(order), Window.partitionBy("k").orderBy(order, "id")
    want = data.select("id", F.row_number().over(whole).alias("row_number"), F.rank().over(by_value).alias("rank"),
                       F.dense_rank().over(by_value).alias("dense_rank"), F.ntile(7).over(whole).alias("ntile"))
    got = windows.ranks(data, ["k"], "t", F.floor(F.col("t") / 8), ["id"], descending, tiles=7)
    columns = ["id", "row_number", "rank", "dense_rank", "ntile"]
    assert rows(got, *columns) == rows(want, *columns)


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "t int")
    assert rows(windows.ranks(df, [], "t", F.col("t"), tiles=10), "t", "ntile") == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_neighbours(spark, data, width):
    plain = Window.partitionBy("k").orderBy(F.asc_nulls_first("t"), "id")
    columns = {"lag3": lambda w: F.lag("v", 3).over(w), "next": lambda w: F.lead("id").over(w),
               "near": lambda w: F.sum("v").over(w.rowsBetween(-3, 2))}
    want = data.withColumns({n: c(plain) for n, c in columns.items()})
    got = windows.neighbours(data, ["k"], ["t", "id"], F.floor(F.col("t") / width), columns, before=3, after=2)
    assert rows(got, "id", *columns) == rows(want, "id", *columns)
    assert got.columns == [*data.columns, *columns]


def test_as_of(spark, data):
    left = data.filter("t IS NOT NULL AND id % 2 = 0").select("k", "t", "id")
    right = data.filter("t IS NOT NULL AND id % 2 = 1").select("k", F.col("t").alias("rt"), F.col("id").alias("rid"), "v")
    got = windows.as_of(left, right, ["k"], "t", "rt", ["rid", "v"], lambda t: F.floor(t / 9), tie="rid")
    rights = right.collect()
    want = []
    for x in left.collect():
        best = max(((r["rt"], r["rid"], r["v"]) for r in rights if r["k"] == x["k"] and r["rt"] <= x["t"]),
                   key=lambda b: b[:2], default=(None, None, None))
        want.append((x["id"], best[1], best[2]))
    assert sorted(rows(got, "id", "rid", "v")) == sorted(want)
    assert got.columns == ["k", "t", "id", "rid", "v"]


@pytest.mark.parametrize("salts", [1, 5])
def test_range_join(spark, salts):
    points = spark.createDataFrame([(i, (i * 37 % 100) / 4 if i % 3 else 5.0) for i in range(300)], "id int, x double")
    bands = spark.createDataFrame([("a", 0.0, 6.0), ("b", 5.0, 5.25), ("c", -3.0, 100.0), ("d", 24.0, 24.0)], "b string, lo double, hi double")
    got = joins.range_join(points, bands, "x", "lo", "hi", 2.5, salts)
    want = [(p["id"], b["b"]) for p in points.collect() for b in bands.collect() if b["lo"] <= p["x"] < b["hi"]]
    assert rows(got, "id", "b") == sorted(want)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_one_wide_band_among_narrow_ones(spark):
    points = [(i, i * 0.37 - 50) for i in range(400)]
    bands = [(1, 0.0, 1.0), (2, -1e9, 1e9), (3, 10.0, 75.0), (4, 20.0, 2000.0), (5, 5.0, 5.0), (6, 9.0, 3.0), (7, -50.0, -49.9)]
    for salts in (1, 3):
        got = joins.range_join(spark.createDataFrame(points, "id int, v double"), spark.createDataFrame(bands, "band int, low double, high double"),
                         "v", "low", "high", 1.0, salts)
        assert rows(got, "id", "band") == sorted((i, b) for i, v in points for b, lo, hi in bands if lo <= v < hi)


def test_pieces_follow_the_data(spark):
    """Nine tenths of a group lie within one day, a twentieth has one value, one group is tiny and one key is NULL."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = 20_000
        day = F.when(F.col("id") % 10 == 0, F.col("id") * 86400).otherwise(F.col("id"))
        rows = spark.range(n).select("id", F.lit("hot").alias("k"), F.when(F.col("id") % 20 != 7, day).otherwise(5000).alias("v"))
        rows = rows.union(spark.range(3).selectExpr("id + 100000", "'small'", "id")).union(
            spark.range(50).selectExpr("id + 200000", "CAST(NULL AS STRING)", "IF(id < 9, NULL, id)"))
        cut = windows.with_pieces(rows, ["k"], "v", 500).cache()
        sizes = {r[0]: r[1] for r in cut.where("k = 'hot' and v <> 5000").groupBy("_piece").count().collect()}
        assert len(sizes) >= 35 and max(sizes.values()) <= 2 * n / 40
        assert cut.groupBy("k", "v").agg(F.count_distinct("_piece").alias("n")).where("n > 1").count() == 0
        order = Window.partitionBy("k").orderBy(F.asc_nulls_first("v"), "id")
        plain = rows.select("id", F.row_number().over(order).cast("bigint").alias("row_number"),
                            F.rank().over(Window.partitionBy("k").orderBy(F.asc_nulls_first("v"))).cast("bigint").alias("rank"),
                            F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("total"))
        ranked = windows.ranks(cut, ["k"], "v", F.col("_piece"), ["id"]).select("id", "row_number", "rank")
        assert sorted(ranked.collect()) == sorted(plain.select("id", "row_number", "rank").collect())
        total = windows.running(cut, ["k"], ["v", "id"], F.col("_piece"), {"total": F.col("v")}).select("id", "total")
        assert sorted(total.collect()) == sorted(plain.select("id", "total").collect())
        assert windows.with_pieces(rows.limit(0), ["k"], "v").collect() == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
