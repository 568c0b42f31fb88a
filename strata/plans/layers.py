"""Bronze, silver and gold queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strata.cluster import scratch_path
from strata.operators import bronze, gold, silver, sketches
from strata.plans.registry import ntz, register, table
from strata.sources import layers, tables

# One batch has one landing time, and it is passed in.
LANDED_AT = datetime(2024, 2, 1)
LANDED_TEXT = "2024-02-01 00:00:00"


def _hash_sql(*columns: str, dates: tuple[str, ...] = ()) -> str:
    """Row hash in oracle SQL: ``name=length:text`` or ``name=~``, in name order."""
    parts = []
    for c in sorted(columns):
        text = f"CAST({c} AS VARCHAR)"
        parts.append(f"'{c}=' || coalesce(length({text}) || ':' || {text}, '~')")
    return "md5(" + " || '|' || ".join(parts) + ")"


_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
_EVENT_HASH = _hash_sql(*_EVENT_COLUMNS)


def _padded_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with stray white space around the name and a NULL segment."""
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("\t  "), "c_name", F.lit(" \n")).alias("c_name"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_mktsegment"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  ")).alias("segment_text"),
    )


def three_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed with audit columns, one row kept per event, aggregated by type: each layer written and read."""
    paths = {layer: scratch_path(spark, layer) for layer in ("bronze", "silver", "gold")}
    bronze.land(table(spark, sf, "events"), paths["bronze"], LANDED_AT, "app", time_column="ts")
    landed = spark.read.parquet(paths["bronze"]).drop("ts_day")
    cleansed, _ = silver.bronze_to_silver(landed, keys=["event_id"], order_by=["ts"])
    layers.land(cleansed, paths["silver"], "silver", "ts")
    totals = gold.aggregate(spark.read.parquet(paths["silver"]), ["event_type"], {"value": "sum", "event_id": "count"}, scale=2)
    layers.land(totals, paths["gold"], "gold")
    return spark.read.parquet(paths["gold"])


register("three_layers", """
    SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value,
           count(event_id) AS event_id
    FROM events GROUP BY event_type
""")(three_layers)


# ---- bronze -------------------------------------------------------------------------------------------------

@register("bronze_audit_columns", f"""
    SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, 'unknown' AS source_system,
           '' AS source_file, {_EVENT_HASH} AS record_hash
    FROM events
""")
def bronze_audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.with_audit_columns(table(spark, sf, "events"), ntz(LANDED_TEXT))


@register("record_hash", f"""
    SELECT o_orderkey, {_hash_sql("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                  "o_orderpriority")} AS record_hash
    FROM orders
""")
def record_hash(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", bronze.record_hash(orders.schema).alias("record_hash"))


@register("bronze_ingest", f"""
    SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, 'app' AS source_system,
           'events.parquet' AS source_file, {_EVENT_HASH} AS record_hash
    FROM events
""")
def bronze_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Appended to a table by day and read back, if the write counted every row."""
    path, events = scratch_path(spark, "bronze"), table(spark, sf, "events")
    landed = bronze.land(events, path, ntz(LANDED_TEXT), "app",
                         F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), "ts")
    return spark.read.parquet(path).filter(F.lit(landed == events.count())).drop("ts_day")


# ---- silver -------------------------------------------------------------------------------------------------

@register("cleanse_trim", """
    SELECT c_custkey, regexp_replace(chr(9) || '  ' || c_name || ' ' || chr(10),
                                     '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS c_name,
           nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, lower(c_mktsegment) AS segment_text
    FROM customer
""")
def cleanse_trim(spark: SparkSession, sf: str) -> DataFrame:
    return silver.trim_strings(_padded_customers(spark, sf))


_LINE_TIES = """l_shipdate {d}, l_partkey {d}, l_suppkey {d}, l_quantity {d}, l_extendedprice {d}, l_discount {d},
                l_tax {d}, l_returnflag {d}, l_linestatus {d}"""


def _dedupe_sql(direction: str) -> str:
    return f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                         ORDER BY {_LINE_TIES.format(d=direction)}) AS rn
            FROM lineitem) WHERE rn = 1
    """


@register("dedupe_last", _dedupe_sql("DESC"))
def dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    return silver.deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register("dedupe_first", _dedupe_sql("ASC"))
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    return silver.deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], "first")


@register("dedupe_against_target", """
    SELECT * FROM lineitem l WHERE NOT EXISTS (
        SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1999-01-01'
          AND t.l_orderkey IS NOT DISTINCT FROM l.l_orderkey AND t.l_linenumber IS NOT DISTINCT FROM l.l_linenumber)
""")
def dedupe_against_target(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    target = lines.filter(F.col("l_shipdate") < ntz("1999-01-01"))
    return silver.without_existing(lines, target, ["l_orderkey", "l_linenumber"])


@register("dedupe_against_partitions", """
    SELECT * FROM lineitem l WHERE NOT EXISTS (
        SELECT 1 FROM lineitem t WHERE t.l_shipdate < TIMESTAMP '1999-01-01'
          AND t.l_orderkey IS NOT DISTINCT FROM l.l_orderkey AND t.l_linenumber IS NOT DISTINCT FROM l.l_linenumber
          AND strftime(t.l_shipdate, '%Y-%m') IS NOT DISTINCT FROM strftime(l.l_shipdate, '%Y-%m'))
""")
def dedupe_against_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same against a landed table, by key and month: only directories of months that come in are read."""
    lines, path, spec = table(spark, sf, "lineitem"), scratch_path(spark, "lines"), [("l_shipdate", "month")]
    tables.write(lines.filter(F.col("l_shipdate") < ntz("1999-01-01")), path, spec)
    fresh = layers.with_partitions(lines, spec)
    month = layers.partition_name(*spec[0])
    return silver.without_existing(
        fresh, spark.read.parquet(path), ["l_orderkey", "l_linenumber"], [month]).drop(month)


_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType(), False),
    T.StructField("balance", T.DoubleType(), True),
    T.StructField("segment", T.StringType(), False),
    T.StructField("points", T.IntegerType(), True),
    T.StructField("since", T.TimestampNTZType(), True),
])

_LOOSE_CUSTOMERS_SQL = """
    SELECT CASE WHEN c_nationkey = 3 THEN c_name ELSE CAST(c_custkey AS VARCHAR) END AS c_custkey,
           CASE WHEN c_nationkey = 7 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS balance,
           nullif(c_mktsegment, 'MACHINERY') AS segment,
           CASE WHEN c_nationkey = 11 THEN c_custkey + 0.5::DOUBLE ELSE c_custkey::DOUBLE END AS points,
           CASE WHEN c_nationkey = 13 THEN '2024' ELSE '2024-01-02 03:04:05' END AS since
    FROM customer
"""


def _loose_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a key or balance that is no number, no segment, a fraction for an integer, or a year for a time."""
    return table(spark, sf, "customer").select(
        F.when(F.col("c_nationkey") == 3, F.col("c_name")).otherwise(F.col("c_custkey").cast("string"))
        .alias("c_custkey"),
        F.when(F.col("c_nationkey") == 7, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
        .alias("balance"),
        F.expr("nullif(c_mktsegment, 'MACHINERY')").alias("segment"),
        F.when(F.col("c_nationkey") == 11, F.col("c_custkey") + 0.5).otherwise(F.col("c_custkey").cast("double")).alias("points"),
        F.when(F.col("c_nationkey") == 13, "2024").otherwise("2024-01-02 03:04:05").alias("since"),
    )


@register("conform_schema", f"""
    SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(balance AS DOUBLE) AS balance, segment,
           CAST(points AS INTEGER) AS points, CAST(since AS TIMESTAMP) AS since
    FROM ({_LOOSE_CUSTOMERS_SQL}) WHERE TRY_CAST(c_custkey AS BIGINT) IS NOT NULL
      AND (balance IS NULL OR TRY_CAST(balance AS DOUBLE) IS NOT NULL) AND segment IS NOT NULL
      AND points = floor(points) AND length(since) > 4
""")
def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    return silver.conform(_loose_customers(spark, sf), _CUSTOMER_SCHEMA)[0]


@register("conform_rejects", f"""
    SELECT * FROM (SELECT *, concat_ws('; ',
        CASE WHEN c_custkey IS NOT NULL AND TRY_CAST(c_custkey AS BIGINT) IS NULL THEN 'c_custkey is not bigint' END,
        CASE WHEN c_custkey IS NULL THEN 'c_custkey is required' END,
        CASE WHEN balance IS NOT NULL AND TRY_CAST(balance AS DOUBLE) IS NULL THEN 'balance is not double' END,
        CASE WHEN segment IS NULL THEN 'segment is required' END,
        CASE WHEN points <> floor(points) THEN 'points is not int' END,
        CASE WHEN length(since) = 4 THEN 'since is not timestamp_ntz' END) AS reasons
    FROM ({_LOOSE_CUSTOMERS_SQL})) WHERE reasons <> ''
""")
def conform_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejected = silver.conform(_loose_customers(spark, sf), _CUSTOMER_SCHEMA)[1]
    return rejected.select("c_custkey", "balance", "segment", "points", "since", F.array_join("conform_errors", "; ").alias("reasons"))


@register("standardize_formats", """
    SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment[1] || lower(c_mktsegment[2:]) AS segment,
           c_acctbal * 0.01::DOUBLE AS balance, DATE '2024-01-31' - CAST(c_nationkey AS INTEGER) AS opened, '' AS errors
    FROM customer WHERE c_nationkey NOT IN (4, 9)
    UNION ALL SELECT c_custkey, '  ' || lower(c_name) || chr(9), ' ' || c_mktsegment, c_acctbal, NULL, 'opened is no date'
    FROM customer WHERE c_nationkey IN (4, 9)
""")
def standardize_formats(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), F.lower("c_name"), F.lit("\t")).alias("c_name"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.when(F.col("c_nationkey") == 4, "31.1.2024").when(F.col("c_nationkey") == 9, "2024").otherwise(
            F.date_sub(F.lit("2024-01-31").cast("date"), F.col("c_nationkey")).cast("string")).alias("opened"),
    )
    good, rejected = silver.standardize(
        raw, {"c_name": "upper", "segment": "title", "balance": "scale:0.01", "opened": "date"})
    return good.withColumn("errors", F.lit("")).unionByName(rejected.withColumns({
        "opened": F.lit(None).cast("date"), "errors": F.array_join("standardize_errors", "; ")}).drop("standardize_errors"))


@register("bronze_to_silver", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, upper(l_returnflag) AS l_returnflag, l_extendedprice, l_shipdate
    FROM ({_dedupe_sql("DESC")})
""")
def bronze_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "lineitem").withColumn("l_returnflag", F.concat(F.lit(" "), "l_returnflag", F.lit("\t")))
    schema = T.StructType([
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("l_linenumber", T.IntegerType(), False),
        T.StructField("l_partkey", T.LongType(), False),
        T.StructField("l_returnflag", T.StringType(), False),
        T.StructField("l_extendedprice", T.DoubleType(), False),
        T.StructField("l_shipdate", T.TimestampNTZType(), False),
    ])
    path = scratch_path(spark, "silver")
    layers.land(silver.bronze_to_silver(raw, schema, ["l_orderkey", "l_linenumber"], ["l_shipdate"])[0], path, "silver",
                "l_shipdate", transform="year")
    return spark.read.parquet(path).drop("l_shipdate_year")


# ---- gold ---------------------------------------------------------------------------------------------------

def _money(expression: str) -> str:
    return f"CAST(sum(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE)"


@register("gold_aggregate", f"""
    SELECT l_returnflag, l_linestatus, {_money("l_quantity")} AS l_quantity,
           {_money("l_extendedprice")} / count(l_extendedprice) AS l_extendedprice, min(l_discount) AS l_discount,
           max(l_tax) AS l_tax, count(l_orderkey) AS l_orderkey
    FROM (SELECT * REPLACE (nullif(l_returnflag, 'N') AS l_returnflag) FROM lineitem)
    WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY l_returnflag, l_linestatus
""")
def gold_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("l_returnflag", F.expr("nullif(l_returnflag, 'N')"))
    path = scratch_path(spark, "gold")
    layers.land(gold.aggregate(
        lines, ["l_returnflag", "l_linestatus"],
        {"l_quantity": "sum", "l_extendedprice": "avg", "l_discount": "min", "l_tax": "max", "l_orderkey": "count"},
        scale=2), path, "gold")
    return spark.read.parquet(path)


@register("gold_metrics", """
    SELECT CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
           CAST(sum(CAST(cost AS DECIMAL(18,2))) AS DOUBLE) AS total_cost,
           CAST(sum(CAST(revenue AS DECIMAL(18,2))) - sum(CAST(cost AS DECIMAL(18,2))) AS DOUBLE) AS profit,
           max(revenue) AS best, count(revenue) AS n
    FROM (SELECT l_extendedprice AS revenue, l_quantity * 10 AS cost FROM lineitem)
""")
def gold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(18,2)").alias("revenue"),
        (F.col("l_quantity") * 10).cast("decimal(18,2)").alias("cost"))
    out = gold.metrics(lines, {"total_revenue": "sum(revenue)", "total_cost": "sum(cost)",
                               "profit": "sum(revenue) - sum(cost)", "best": "max(revenue)", "n": "count(revenue)"})
    return out.select(*[F.col(c).cast("double").alias(c) for c in ("total_revenue", "total_cost", "profit", "best")],
                      "n")


@register("gold_ml_features", """
    SELECT c_custkey, c_acctbal, c_nationkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS is_building FROM customer
""")
def gold_ml_features(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").withColumn(
        "is_building", (F.col("c_mktsegment") == "BUILDING").cast("int"))
    return gold.ml_features(customers, ["c_custkey", "c_acctbal", "c_nationkey"], "is_building")


@register("gold_denormalize", """
    SELECT o_orderkey, o_totalprice, o_orderdate, c_name, c_mktsegment, n_name, r_name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN region ON n_regionkey = r_regionkey
""")
def gold_denormalize(spark: SparkSession, sf: str) -> DataFrame:
    wide = gold.denormalize(
        table(spark, sf, "orders"),
        (table(spark, sf, "customer"), "o_custkey", "c_custkey"),
        (table(spark, sf, "nation"), "c_nationkey", "n_nationkey"),
        (table(spark, sf, "region"), "n_regionkey", "r_regionkey"))
    return wide.select("o_orderkey", "o_totalprice", "o_orderdate", "c_name", "c_mktsegment", "n_name", "r_name")


@register("gold_rollup_time", f"""
    SELECT unit, period, event_type, events, revenue FROM (
        SELECT 'day' AS unit, date_trunc('day', ts)::TIMESTAMP AS period, event_type, count(*) AS events,
               {_money("value")} AS revenue FROM events GROUP BY ALL
        UNION ALL SELECT 'week', date_trunc('week', ts)::TIMESTAMP, event_type, count(*), {_money("value")}
        FROM events GROUP BY ALL
        UNION ALL SELECT 'month', date_trunc('month', ts)::TIMESTAMP, event_type, count(*), {_money("value")}
        FROM events GROUP BY ALL)
""")
def gold_rollup_time(spark: SparkSession, sf: str) -> DataFrame:
    """Days come from the events; weeks and months from the days, so the events are read once."""
    money = F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue")
    daily = gold.rollup_time(table(spark, sf, "events"), "ts", "day",
                             [F.count(F.lit(1)).alias("events"), money], ["event_type"])
    coarser = [
        gold.rollup_time(daily.withColumnRenamed("period", "day"), "day", unit,
                         [F.sum("events").alias("events"), F.sum("revenue").cast("decimal(38,2)").alias("revenue")],
                         ["event_type"]).withColumn("unit", F.lit(unit))
        for unit in ("week", "month")
    ]
    out = daily.withColumn("unit", F.lit("day"))
    for frame in coarser:
        out = out.unionByName(frame)
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@register("gold_unique_users", """
    SELECT date_trunc('day', ts)::TIMESTAMP AS period, event_type, count(DISTINCT user_id) AS users, count(*) AS events
    FROM events GROUP BY ALL
""")
def gold_unique_users(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per user first: the distinct step then works on users, not on events."""
    per_user = gold.rollup_time(table(spark, sf, "events"), "ts", "day",
                                [F.count(F.lit(1)).alias("n")], ["event_type", "user_id"])
    return per_user.groupBy("period", "event_type").agg(F.count("user_id").alias("users"), F.sum("n").alias("events"))


@register("gold_unique_users_approx", """
    SELECT date_trunc('day', ts)::TIMESTAMP AS period, event_type, count(DISTINCT user_id) AS users, true AS within
    FROM events GROUP BY ALL
""")
def gold_unique_users_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Users per day and type, and whether the stored sketch's number lies within a tenth of it (or one user)."""
    near = _stored_users(spark, sf).select("period", "event_type", sketches.distinct_count("users").alias("near"))
    exact = gold_unique_users(spark, sf).select("period", "event_type", "users")
    return exact.join(near, ["period", "event_type"]).select("period", "event_type", "users", (
        F.abs(F.col("near") - F.col("users")) <= 0.1 * F.col("users") + 1).alias("within"))


@register("gold_unique_users_range", """
    SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS events, true AS within
    FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-02-20' GROUP BY event_type
""")
def gold_unique_users_range(spark: SparkSession, sf: str) -> DataFrame:
    """Users and events per type over a range of days, from the stored daily sketches alone; beside the exact number of
    users whether theirs is within a twentieth (or one user)."""
    first, end = ntz("2024-01-05"), ntz("2024-02-20")
    some = _stored_users(spark, sf).where((F.col("period") >= first) & (F.col("period") < end))
    near = sketches.merged(some, ["event_type"], ["users"]).select(
        "event_type", F.col("rows").alias("events"), sketches.distinct_count("users").alias("near"))
    exact = (table(spark, sf, "events").where((F.col("ts") >= first) & (F.col("ts") < end))
             .groupBy("event_type").agg(F.count_distinct("user_id").alias("users")))
    return exact.join(near, "event_type").select("event_type", "users", "events", (
        F.abs(F.col("near") - F.col("users")) <= 0.05 * F.col("users") + 1).alias("within"))


def _stored_users(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "users")
    sketches.daily(table(spark, sf, "events"), "ts", {"users": F.col("user_id")}, by=["event_type"]).write.parquet(path)
    return spark.read.parquet(path)


@register("gold_kpis", f"""
    SELECT period, orders, revenue, revenue / orders AS avg_order_value, previous_revenue,
           revenue - previous_revenue AS revenue_change,
           (revenue - previous_revenue) / previous_revenue AS revenue_growth
    FROM (SELECT *, lag(revenue) OVER (ORDER BY period) AS previous_revenue FROM (
        SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS period, count(*) AS orders,
               {_money("o_totalprice")} AS revenue
        FROM orders GROUP BY ALL))
""")
def gold_kpis(spark: SparkSession, sf: str) -> DataFrame:
    monthly = gold.rollup_time(table(spark, sf, "orders"), "o_orderdate", "month",
                               [F.count(F.lit(1)).alias("orders"), gold.exact_sum("o_totalprice", 2).alias("revenue")])
    monthly = monthly.withColumn("avg_order_value", F.try_divide("revenue", "orders"))
    return gold.period_over_period(monthly, "period", "revenue")


@register("customer_360", f"""
    SELECT c_custkey, c_name, c_mktsegment, coalesce(orders, 0) AS orders, coalesce(spent, 0) AS spent, last_order,
           coalesce(events, 0) AS events, last_event
    FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS orders, {_money("o_totalprice")} AS spent,
                      max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS events, max(ts) AS last_event FROM events GROUP BY user_id)
         ON user_id = c_custkey
""")
def customer_360(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), gold.exact_sum("o_totalprice", 2).alias("spent"),
        F.max("o_orderdate").alias("last_order"))
    events = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("events"), F.max("ts").alias("last_event"))
    base = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return gold.unify(base, "c_custkey", orders, events).fillna(0, ["orders", "spent", "events"])
