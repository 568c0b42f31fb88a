"""SQL over the layers: the general query operator, and one worked query per category of SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.cluster import scratch_path
from strata.operators import gold, joins, sketches, windows
from strata.operators.query import sql_query as run_sql
from strata.plans.registry import register, table

# Windows over large groups are cut into pieces of about so many rows.
_PIECE_ROWS = 2_000


def _sql(spark: SparkSession, sf: str, text: str, *names: str, **params) -> DataFrame:
    """Run text in which ``{orders}`` stands for the orders table."""
    return run_sql(spark, text, {n: table(spark, sf, n) for n in names}, params)


def _same(key: str, text: str, *names: str) -> None:
    """Register SQL that both engines read alike; Spark gets the tables as arguments."""
    bare = text
    for n in names:
        bare = bare.replace("{" + n + "}", n)

    @register(key, bare)
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _sql(spark, sf, text, *names)


@register("sql_query", """
    SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' AND o_totalprice > 300000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
""")
def sql_query(spark: SparkSession, sf: str) -> DataFrame:
    """Text with bound parameters; the cap is part of the plan (top-k), nothing is fetched and cut."""
    return run_sql(
        spark,
        """SELECT o_orderkey, o_totalprice, c_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey
           WHERE c_mktsegment = :segment AND o_totalprice > :least ORDER BY o_totalprice DESC, o_orderkey""",
        {n: table(spark, sf, n) for n in ("orders", "customer")}, {"segment": "BUILDING", "least": 300000}, limit=25)


_same("sql_agg_order", """
    SELECT l_returnflag, l_linestatus, count(*) AS lines, min(l_quantity) AS least, max(l_extendedprice) AS most,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
    FROM {lineitem} WHERE l_shipdate <= TIMESTAMP '2000-09-02 00:00:00'
    GROUP BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus
""", "lineitem")

_same("sql_joins", """
    SELECT 'inner' AS how, n_name AS a, CAST(count(*) AS BIGINT) AS n FROM {supplier}
    JOIN {nation} ON s_nationkey = n_nationkey GROUP BY n_name
    UNION ALL SELECT 'left', c_mktsegment, CAST(count(o_orderkey) AS BIGINT) FROM {customer}
    LEFT JOIN {orders} ON c_custkey = o_custkey AND o_totalprice > 400000 GROUP BY c_mktsegment
    UNION ALL SELECT 'right', n_name, CAST(count(s_suppkey) AS BIGINT) FROM {supplier}
    RIGHT JOIN {nation} ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY n_name
    UNION ALL SELECT 'full', CASE WHEN s_nationkey IS NULL THEN 'customers only' WHEN c_nationkey IS NULL
         THEN 'suppliers only' ELSE 'both' END, CAST(count(*) AS BIGINT)
    FROM (SELECT s_nationkey FROM {supplier} WHERE s_nationkey < 20 GROUP BY s_nationkey) s
    FULL JOIN (SELECT c_nationkey FROM {customer} WHERE c_nationkey > 5 GROUP BY c_nationkey) c
         ON s_nationkey = c_nationkey GROUP BY 2
""", "supplier", "nation", "customer", "orders")

_SEMI_ANTI = """
    SELECT 'exists' AS how, c_custkey FROM {customer} WHERE EXISTS (
        SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 490000)
    UNION ALL SELECT 'not exists', c_custkey FROM {customer} WHERE NOT EXISTS (
        SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
    UNION ALL SELECT 'in', c_custkey FROM {customer} WHERE c_nationkey IN (
        SELECT n_nationkey FROM {nation} WHERE n_regionkey = 2)
    UNION ALL SELECT 'not in', c_custkey FROM {customer} WHERE """

# What NOT IN asks, as an anti join that needs no broadcast: nothing equal, and no NULL on either side.
_NOT_IN = """c_nationkey IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {nation} WHERE n_regionkey <> 1 AND n_nationkey = c_nationkey)
        AND (SELECT count(*) FROM {nation} WHERE n_regionkey <> 1 AND n_nationkey IS NULL) = 0"""


@register("sql_semi_anti", _SEMI_ANTI.replace("{", "").replace("}", "")
          + "c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)")
def sql_semi_anti(spark: SparkSession, sf: str) -> DataFrame:
    return _sql(spark, sf, _SEMI_ANTI + _NOT_IN, "customer", "orders", "nation")


@register("sql_range_join", """
    SELECT p_size, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events JOIN (SELECT DISTINCT p_size, CAST(p_size * 10 AS DOUBLE) AS low, CAST(p_size * 10 + 15 AS DOUBLE)
                             AS high FROM part) ON value >= low AND value < high
    GROUP BY p_size
""")
def sql_range_join(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose value falls in a part size's band; bands overlap, and values crowd at the low end (salted)."""
    bands = table(spark, sf, "part").select("p_size").distinct().select(
        "p_size", (F.col("p_size") * 10).cast("double").alias("low"),
        (F.col("p_size") * 10 + 15).cast("double").alias("high"))
    hits = joins.range_join(table(spark, sf, "events").select("event_id", "value"), bands, "value", "low", "high",
                            width=15, salts=4)
    return hits.groupBy("p_size").agg(F.count(F.lit(1)).alias("events"), gold.exact_sum("value", 2).alias("total"))


@register("sql_asof_join", """
    SELECT e.event_id, e.user_id, e.ts, p.event_id AS purchase_id, p.value AS purchase_value
    FROM (SELECT * FROM events WHERE event_type = 'error') e
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts
""")
def sql_asof_join(spark: SparkSession, sf: str) -> DataFrame:
    """The user's latest purchase at or before each error."""
    events = table(spark, sf, "events")
    errors = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    purchases = events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("purchase_id"),
        F.col("value").alias("purchase_value"))
    return windows.as_of(errors, purchases, ["user_id"], "ts", "bought_at", ["purchase_id", "purchase_value"],
                         lambda t: F.to_date(t), tie="purchase_id")


_same("sql_distinct_agg", """
    SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers,
           count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS finished_customers,
           count(*) FILTER (WHERE o_totalprice > 250000) AS large, count(*) AS orders
    FROM {orders} GROUP BY o_orderpriority
""", "orders")

_same("sql_grouping_sets", """
    SELECT 'sets' AS kind, o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n,
           CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS level
    FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())
    UNION ALL SELECT 'cube', o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT),
           CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT)
    FROM {orders} GROUP BY CUBE (o_orderstatus, o_orderpriority)
    UNION ALL SELECT 'rollup', o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT),
           CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT)
    FROM {orders} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
""", "orders")


@register("sql_window_rank", """
    SELECT o_orderkey, o_orderpriority, row_number() OVER w AS row_number,
           rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank,
           dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS dense_rank,
           ntile(10) OVER w AS ntile
    FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)
""")
def sql_window_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks within five huge groups, each group cut at quantiles of its prices."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    pieces = windows.with_pieces(orders, ["o_orderpriority"], "o_totalprice", _PIECE_ROWS)
    out = windows.ranks(pieces, ["o_orderpriority"], "o_totalprice", F.col("_piece"), ["o_orderkey"], descending=True, tiles=10)
    return out.drop("o_totalprice", "_piece")


_same("sql_topk_per_group", """
    SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(rn AS BIGINT) AS place FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn
        FROM {orders}) t WHERE rn <= 20
""", "orders")


@register("sql_window_frames", """
    SELECT event_id, event_type, lag(value) OVER w AS previous, lead(event_id, 2) OVER w AS second_next,
           CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_three,
           count(*) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen,
           CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
               AS running
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
""")
def sql_window_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours, a moving and a running frame within five huge groups, each group cut at quantiles of its times."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts",
                                               F.col("value").cast("decimal(18,2)").alias("value"))
    events = windows.with_pieces(events, ["event_type"], "ts", _PIECE_ROWS)
    piece, order = F.col("_piece"), ["ts", "event_id"]
    near = windows.neighbours(
        events, ["event_type"], order, piece, before=2, after=2, columns={
            "previous": lambda w: F.lag("value").over(w).cast("double"),
            "second_next": lambda w: F.lead("event_id", 2).over(w),
            "last_three": lambda w: F.sum("value").over(w.rowsBetween(-2, 0)).cast("double")})
    out = windows.running(near, ["event_type"], order, piece, {"seen": F.lit(1).cast("bigint"), "running": F.col("value")})
    return out.withColumn("running", F.col("running").cast("double")).drop("ts", "value", "_piece")


_same("sql_set_ops", """
    SELECT 'union' AS op, k FROM (SELECT o_custkey AS k FROM {orders} UNION SELECT user_id FROM {events}) a
    UNION ALL SELECT 'intersect', k FROM (
        SELECT o_custkey AS k FROM {orders} INTERSECT SELECT user_id FROM {events}) b
    UNION ALL SELECT 'except', k FROM (
        SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey FROM {orders} WHERE o_totalprice > 200000) c
    UNION ALL SELECT 'except all', k FROM (
        SELECT o_custkey AS k FROM {orders} EXCEPT ALL SELECT c_custkey FROM {customer}) d
""", "orders", "events", "customer")

_same("sql_subqueries", """
    WITH spent AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
                   FROM {orders} GROUP BY o_custkey)
    SELECT o.o_orderkey, o.o_totalprice, s.total FROM {orders} o JOIN spent s ON s.o_custkey = o.o_custkey
    WHERE o.o_totalprice = (SELECT max(i.o_totalprice) FROM {orders} i WHERE i.o_custkey = o.o_custkey)
      AND s.total > (SELECT avg(total) FROM spent)
""", "orders")


@register("sql_string_date_math", """
    SELECT o_orderkey, upper(substr(o_orderpriority, 3)) AS priority, length(o_orderpriority) AS width,
           replace(o_orderpriority, '-', '/') AS slashed, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS padded,
           CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q,
           CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS age,
           CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, CAST(o_custkey % 7 AS BIGINT) AS m,
           round(sqrt(o_totalprice), 4) AS root, greatest(o_totalprice, 100000) AS at_least,
           coalesce(nullif(o_orderstatus, 'P'), '?') AS state
    FROM orders
""")
def sql_string_date_math(spark: SparkSession, sf: str) -> DataFrame:
    return _sql(spark, sf, """
        SELECT o_orderkey, upper(substr(o_orderpriority, 3)) AS priority, CAST(length(o_orderpriority) AS BIGINT) AS width,
               replace(o_orderpriority, '-', '/') AS slashed, lpad(CAST(o_custkey AS STRING), 8, '0') AS padded,
               year(o_orderdate) AS y, quarter(o_orderdate) AS q, date_add(CAST(o_orderdate AS DATE), 30) AS due,
               CAST(datediff(DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS age,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, o_custkey % 7 AS m,
               round(sqrt(o_totalprice), 4) AS root, greatest(o_totalprice, 100000D) AS at_least,
               coalesce(nullif(o_orderstatus, 'P'), '?') AS state
        FROM {orders}
    """, "orders")


@register("sql_json_array_map", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, item, place,
           CAST(list_sum(list_transform([user_id, event_id, 3], lambda x: x * 2)) AS BIGINT) AS doubled,
           list_contains([event_type, 'view'], 'view') AS has_view, map([event_type, 'n'], [1, 2])['n'] AS n
    FROM events, (SELECT unnest(['a', 'b']) AS item, unnest([0, 1]) AS place)
    WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50
""")
def sql_json_array_map(spark: SparkSession, sf: str) -> DataFrame:
    return _sql(spark, sf, """
        SELECT event_id, from_json(props, 'k BIGINT').k AS k, item, place,
               aggregate(transform(array(user_id, event_id, 3L), x -> x * 2), 0L, (a, x) -> a + x) AS doubled,
               array_contains(array(event_type, 'view'), 'view') AS has_view,
               element_at(map(event_type, 1, 'n', 2), 'n') AS n
        FROM {events} LATERAL VIEW posexplode(array('a', 'b')) AS place, item
        WHERE CAST(get_json_object(props, '$.k') AS BIGINT) >= 50
    """, "events")


@register("sql_approx", """
    SELECT l_returnflag, count(*) AS lines, count(DISTINCT l_orderkey) AS orders, true AS orders_within,
           true AS median_within
    FROM lineitem GROUP BY l_returnflag
""")
def sql_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Exact counts, and whether the approximate ones are near: distinct orders within 5 %, the median within 1 % of its
    rank. Approximate answers come from sketches per ship month, stored and joined; exact ones are counted apart."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_extendedprice", "l_shipdate")
    path = scratch_path(spark, "sketches")
    sketches.daily(lines, "l_shipdate", {"order_keys": F.col("l_orderkey")}, {"prices": F.col("l_extendedprice")},
                   ["l_returnflag"], "month").write.parquet(path)
    near = sketches.merged(spark.read.parquet(path), ["l_returnflag"], ["order_keys"], ["prices"]).select(
        "l_returnflag", sketches.distinct_count("order_keys").alias("near_orders"),
        sketches.quantile("prices", 0.5).alias("quantile"))
    exact = _sql(spark, sf, """
        SELECT l_returnflag, count(*) AS lines, count(DISTINCT l_orderkey) AS orders FROM {lineitem} GROUP BY l_returnflag
    """, "lineitem")
    far = sketches.rank_error(lines, "l_extendedprice", near, ["l_returnflag"], 0.5)
    return exact.join(near, "l_returnflag").join(far, "l_returnflag").select(
        "l_returnflag", "lines", "orders", (F.abs(F.col("near_orders") - F.col("orders")) <= 0.05 * F.col("orders"))
        .alias("orders_within"), (F.col("rank_error") <= 0.01).alias("median_within"))
