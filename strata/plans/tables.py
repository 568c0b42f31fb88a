"""Scan, table write, partition, schema and version queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strata.cluster import scratch_path
from strata.functions.text import record_hash
from strata.plans.registry import ntz, register, table
from strata.sources import layers, maintenance, tables, versions
from strata.sources.versions import History

# ---- scans --------------------------------------------------------------------------------------------------


@register("scan_project_filter", """
    SELECT l_orderkey, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01' AND l_discount > 0.05
""")
def scan_project_filter(spark: SparkSession, sf: str) -> DataFrame:
    where = ((F.col("l_shipdate") >= ntz("1998-01-01")) & (F.col("l_shipdate") < ntz("1999-01-01"))
             & (F.col("l_discount") > 0.05))
    return layers.scan(table(spark, sf, "lineitem"), ["l_orderkey", "l_extendedprice"], where)


@register("scan_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def scan_limit(spark: SparkSession, sf: str) -> DataFrame:
    return layers.scan(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"],
                       order_by=[F.desc("o_totalprice"), "o_orderkey"], limit=100)


@register("ingest_files", """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, 'csv' AS kind FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE), 'json' FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE), 'parquet' FROM orders
""")
def ingest_files(spark: SparkSession, sf: str) -> DataFrame:
    """Orders out to CSV, JSON and Parquet files, loaded with a declared schema into raw tables, and read from those."""
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderdate", T.DateType())])
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    out = []
    for kind in ("csv", "json", "parquet"):
        path = scratch_path(spark, f"files-{kind}")
        writer = orders.write.option("header", "true") if kind == "csv" else orders.write
        writer.format(kind).save(path)
        target = scratch_path(spark, f"raw-{kind}")
        layers.ingest_files(spark, path, kind, schema, target, "bronze", "o_orderdate", "year")
        out.append(spark.read.parquet(target).select(*schema.names, F.lit(kind).alias("kind")))
    return out[0].union(out[1]).union(out[2])


# ---- tables on storage --------------------------------------------------------------------------------------

_BY_YEAR = [("o_orderdate", "year")]
_EARLY = "o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'"


def _orders_table(spark: SparkSession, sf: str, name: str) -> tuple[str, DataFrame]:
    """Orders appended in two batches, by year of the order."""
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, name)
    tables.write(orders.filter(_EARLY), path, [("o_orderdate", "year")])
    tables.write(orders.filter(f"NOT ({_EARLY})"), path, [("o_orderdate", "year")])
    return path, orders


@register("table_append", "SELECT * FROM orders")
def table_append(spark: SparkSession, sf: str) -> DataFrame:
    path, orders = _orders_table(spark, sf, "append")
    return spark.read.parquet(path).select(orders.columns)


@register("table_overwrite", """
    SELECT * FROM orders WHERE o_orderstatus = 'O' OR year(o_orderdate) < 2000
""")
def table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """The years from 2000 on are replaced by their open orders; earlier years are not touched."""
    path, orders = _orders_table(spark, sf, "overwrite")
    tables.write(orders.filter("o_orderstatus = 'O' AND year(o_orderdate) >= 2000"), path, [("o_orderdate", "year")], "overwrite")
    return spark.read.parquet(path).select(orders.columns)


@register("table_delete_where", """
    SELECT * FROM orders WHERE (nullif(o_orderpriority, '5-LOW') = '1-URGENT' AND o_totalprice > 100000) IS NOT TRUE
""")
def table_delete_where(spark: SparkSession, sf: str) -> DataFrame:
    """Rows for which the condition is NULL stay; only years with a matching row are rewritten."""
    path, orders = _orders_table(spark, sf, "delete")
    maintenance.delete_where(
        spark, path, "nullif(o_orderpriority, '5-LOW') = '1-URGENT' AND o_totalprice > 100000", _BY_YEAR)
    return spark.read.parquet(path).select(orders.columns)


@register("table_compact", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def table_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Small files of each year are packed along a curve through date and customer; the layout stays."""
    path, orders = _orders_table(spark, sf, "compact")
    maintenance.delete_where(spark, path, "o_orderstatus = 'P'", _BY_YEAR)
    maintenance.compact(spark, path, _BY_YEAR, ["o_orderdate", "o_custkey"])
    return spark.read.parquet(path).select(orders.columns)


@register("table_stats", """
    SELECT 'orders' AS table_name, count(*) AS row_count, 'bronze' AS layer, 90 AS retention_days,
           true AS has_bytes, count(DISTINCT year(o_orderdate)) AS directories
    FROM orders
""")
def table_stats(spark: SparkSession, sf: str) -> DataFrame:
    path, _ = _orders_table(spark, sf, "stats")
    profile = layers.LAYERS["bronze"]
    years = spark.read.parquet(path).select(F.count_distinct("o_orderdate_year").alias("directories"))
    return tables.file_stats(spark, path).select(
        F.lit("orders").alias("table_name"), "row_count", F.lit(profile.name).alias("layer"),
        F.lit(profile.retention_days).alias("retention_days"), (F.col("size_bytes") > 0).alias("has_bytes"),
        F.lit(years.first()["directories"]).cast("long").alias("directories"))


@register("partition_transforms", """
    SELECT event_id, strftime(ts, '%Y') AS ts_year, strftime(ts, '%Y-%m') AS ts_month,
           strftime(ts, '%Y-%m-%d') AS ts_day, strftime(ts, '%Y-%m-%d-%H') AS ts_hour,
           event_type AS event_type_identity
    FROM events
""")
def partition_transforms(spark: SparkSession, sf: str) -> DataFrame:
    spec = [("ts", "year"), ("ts", "month"), ("ts", "day"), ("ts", "hour"), ("event_type", "identity")]
    return layers.with_partitions(table(spark, sf, "events"), spec).select(
        "event_id", *[layers.partition_name(*s) for s in spec])


@register("partition_pruned_read", """
    SELECT event_id, ts, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:00:00'
""")
def partition_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    """Events written by day; the read touches three directories."""
    path = scratch_path(spark, "by-day")
    layers.write_layer(table(spark, sf, "events"), path, "bronze", "ts")
    return layers.between(spark.read.parquet(path), "ts", ntz("2024-01-10 06:00:00"), ntz("2024-01-12 18:00:00"),
                          [("ts", "day")]).select("event_id", "ts", "value")


@register("partition_add_field", """
    SELECT event_id, event_type, ts, strftime(ts, '%Y-%m-%d') AS ts_day,
           CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN event_type END AS event_type_identity
    FROM events
""")
def partition_add_field(spark: SparkSession, sf: str) -> DataFrame:
    """The first half of the month by day; the second half also by event type."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    layouts = [scratch_path(spark, "by-day"), scratch_path(spark, "by-day-and-type")]
    tables.write(events.filter(F.col("ts") < ntz("2024-01-15")), layouts[0], [("ts", "day")])
    tables.write(events.filter(F.col("ts") >= ntz("2024-01-15")), layouts[1], [("ts", "day"), ("event_type", "identity")])
    return tables.read_layouts(spark, *layouts).withColumn("ts_day", F.col("ts_day").cast("string"))


@register("schema_evolve", """
    SELECT c_custkey, c_name AS full_name, CAST(c_nationkey AS BIGINT) AS nation, NULL::VARCHAR AS segment
    FROM customer WHERE c_acctbal < 5000
    UNION ALL SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT), c_mktsegment FROM customer
    WHERE c_acctbal >= 5000
""")
def schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of an old schema (other name, narrower key, a column since dropped, no segment) read under the new one."""
    customers = table(spark, sf, "customer")
    old = customers.filter("c_acctbal < 5000").select("c_custkey", "c_name", F.col("c_nationkey").alias("nation"),
                                                      "c_acctbal")
    new = customers.filter("c_acctbal >= 5000").select(
        "c_custkey", F.col("c_name").alias("full_name"), F.col("c_nationkey").cast("bigint").alias("nation"),
        F.col("c_mktsegment").alias("segment"))
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("full_name", T.StringType()),
                           T.StructField("nation", T.LongType()), T.StructField("segment", T.StringType())])
    return layers.read_versions([(old, {"c_name": "full_name"}), (new, {})], schema)


@register("read_incremental", """
    SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')
""")
def read_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Events after the mark the last run left, read from a table by day: days before the mark are not opened."""
    events = table(spark, sf, "events").select("event_id", "ts")
    mark = layers.high_water_mark(events.filter(F.col("ts") < ntz("2024-01-20")), "ts").first()["high_water_mark"]
    path = scratch_path(spark, "incremental")
    tables.write(events, path, [("ts", "day")])
    return layers.newer_than(spark.read.parquet(path), "ts", mark, [("ts", "day")]).select("event_id", "ts")


@register("retention_purge", """
    SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-04-10' - INTERVAL 90 DAY
""")
def retention_purge(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of a table by day after ninety days: days that are out are dropped whole, without being read."""
    path, days = scratch_path(spark, "retention"), [("ts", "day")]
    tables.write(table(spark, sf, "events").select("event_id", "ts"), path, days)
    oldest = layers.oldest_kept("bronze", ntz("2024-04-10"))
    maintenance.purge_before(spark, path, "ts", oldest, days)
    return spark.read.parquet(path).select("event_id", "ts")


# ---- versions -----------------------------------------------------------------------------------------------
#
# History of orders: commit = order year (1995-2001), appended in turn; finished orders ('F') are closed by the
# commit one year later; commit 2002 rolls back to 1997; commit 2003 appends the urgent orders again with status X.

def order_history(spark: SparkSession, sf: str) -> History:
    """The history as frames over the orders, without writing it anywhere."""
    orders = table(spark, sf, "orders")
    hashed = orders.withColumns({"commit_id": F.year("o_orderdate").cast("bigint"),
                                 "record_hash": record_hash(orders.schema)})
    again = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("X"))
    again = again.withColumns({"commit_id": F.lit(2003).cast("bigint"), "record_hash": record_hash(orders.schema)})
    rows = hashed.unionByName(again)
    closes = hashed.filter("o_orderstatus = 'F' AND commit_id < 2001").select(
        (F.col("commit_id") + 1).alias("commit_id"), "record_hash")
    start = F.lit(1995).cast("bigint")
    commit = F.col("commit_id")
    yearly = hashed.select("commit_id").distinct().select(
        "commit_id", F.when(commit > start, commit - 1).alias("parent_id"),
        F.make_timestamp_ntz(commit.cast("int") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        .alias("committed_at"), F.lit("append").alias("op"),
        F.array(F.struct(start.alias("first"), commit.alias("last"))).alias("visible"),
        F.lit(None).cast("string").alias("schema_json"),
        F.when(commit > start, F.array(F.struct((commit - 1).alias("first"), (commit - 1).alias("last"))))
        .otherwise(versions.ranges_column([])).alias("touched"))
    back = versions.commit_row(spark, 2002, 1997, [(1995, 1997), (2002, 2002)], "rollback", datetime(2003, 1, 1))
    later = versions.commit_row(spark, 2003, 2002, [(1995, 1997), (2002, 2003)], "append", datetime(2004, 1, 1))
    return History(rows, closes, yearly.unionByName(back).unionByName(later))


_DATA = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_HISTORY_SQL = f"""
    WITH RECURSIVE r AS (
        SELECT *, CAST(year(o_orderdate) AS BIGINT) AS commit_id, CAST(o_orderkey AS VARCHAR) AS row_id FROM orders
        UNION ALL SELECT * REPLACE ('X' AS o_orderstatus), 2003, 'x' || o_orderkey
        FROM orders WHERE o_orderpriority = '1-URGENT'),
    closes AS (SELECT commit_id + 1 AS commit_id, row_id FROM r
               WHERE o_orderstatus = 'F' AND commit_id < 2001),
    commits AS (
        SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS commit_id,
               CASE WHEN year(o_orderdate) > 1995 THEN CAST(year(o_orderdate) - 1 AS BIGINT) END AS parent_id,
               make_timestamp(year(o_orderdate) + 1, 1, 1, 0, 0, 0) AS committed_at, 'append' AS op FROM orders
        UNION ALL VALUES (2002, 1997, TIMESTAMP '2003-01-01', 'rollback'),
                         (2003, 2002, TIMESTAMP '2004-01-01', 'append')),
    ancestors(version, commit_id) AS (
        SELECT commit_id, commit_id FROM commits
        UNION SELECT a.version, c.parent_id FROM ancestors a JOIN commits c ON c.commit_id = a.commit_id
        WHERE c.parent_id IS NOT NULL),
    state AS (
        SELECT a.version, r.* FROM r JOIN ancestors a ON a.commit_id = r.commit_id
        WHERE NOT EXISTS (SELECT 1 FROM closes c JOIN ancestors b ON b.commit_id = c.commit_id
                          WHERE b.version = a.version AND c.row_id = r.row_id AND c.commit_id > r.commit_id))
"""


def _data(state: DataFrame) -> DataFrame:
    return state.drop("commit_id", "record_hash")


@register("snapshots_list", f"""{_HISTORY_SQL}
    SELECT commit_id AS snapshot_id, epoch_ms(committed_at) AS timestamp_ms,
           strftime(committed_at, '%Y-%m-%dT%H:%M:%S.%g') AS "timestamp", op, parent_id
    FROM commits
""")
def snapshots_list(spark: SparkSession, sf: str) -> DataFrame:
    return order_history(spark, sf).snapshots()


@register("read_at_snapshot", f"{_HISTORY_SQL} SELECT {_DATA} FROM state WHERE version = 1999")
def read_at_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _data(order_history(spark, sf).at(1999))


@register("read_at_timestamp", f"""{_HISTORY_SQL}
    SELECT {_DATA} FROM state WHERE version = (
        SELECT commit_id FROM commits WHERE committed_at <= TIMESTAMP '2001-06-15'
        ORDER BY committed_at DESC, commit_id DESC LIMIT 1)
""")
def read_at_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return _data(order_history(spark, sf).at_time(datetime(2001, 6, 15)))


@register("rollback_to_snapshot", f"{_HISTORY_SQL} SELECT {_DATA} FROM state WHERE version = 1996")
def rollback_to_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """After the rollback the current table is the old version."""
    return _data(order_history(spark, sf).rolled_back(1996, datetime(2005, 1, 1)).current())


@register("read_current", f"{_HISTORY_SQL} SELECT {_DATA} FROM state WHERE version = 2003")
def read_current(spark: SparkSession, sf: str) -> DataFrame:
    return _data(order_history(spark, sf).current())


@register("snapshot_expire", f"""{_HISTORY_SQL}
    SELECT version, {_DATA} FROM state WHERE version IN (2001, 2003)
    UNION ALL SELECT -1, NULL, NULL, CAST(count(*) AS VARCHAR), NULL, NULL, NULL FROM commits
    WHERE committed_at >= TIMESTAMP '2001-06-01'
""")
def snapshot_expire(spark: SparkSession, sf: str) -> DataFrame:
    """Reads of two kept versions after the expiry, and how many versions are left."""
    kept = order_history(spark, sf).expired(datetime(2001, 6, 1))
    reads = [_data(kept.at(v)).withColumn("version", F.lit(v).cast("bigint")) for v in (2001, 2003)]
    left = kept.commits.agg(F.count(F.lit(1)).cast("string").alias("o_orderstatus"), F.lit(-1).cast("bigint").alias("version"))
    return reads[0].unionByName(reads[1]).unionByName(left, allowMissingColumns=True)


@register("changelog_apply", """
    SELECT user_id, event_id, ts, event_type AS op, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'
""")
def changelog_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Events as changes per user: an error deletes the user, anything else inserts or updates."""
    changes = table(spark, sf, "events").select("user_id", "event_id", "ts", F.col("event_type").alias("op"), "value")
    return versions.latest_state(changes, ["user_id"], ["ts", "event_id"], F.col("op") == "error")


@register("changelog_between", f"""{_HISTORY_SQL},
    a AS (SELECT row_id, {_DATA} FROM state WHERE version = 1998),
    b AS (SELECT row_id, {_DATA} FROM state WHERE version = 2003)
    SELECT 'added' AS change, CAST(1 AS BIGINT) AS copies, {_DATA} FROM b
    WHERE row_id NOT IN (SELECT row_id FROM a)
    UNION ALL SELECT 'removed', 1, {_DATA} FROM a WHERE row_id NOT IN (SELECT row_id FROM b)
""")
def changelog_between(spark: SparkSession, sf: str) -> DataFrame:
    return order_history(spark, sf).changes(1998, 2003)
