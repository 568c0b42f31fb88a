"""Quality, lineage, protection and operational metrics queries."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.cluster import checkpointed
from strata.functions import events as ev
from strata.operators import lineage, opsmetrics, protect, quality
from strata.operators.quality import Rule
from strata.plans.inputs import ENVELOPES_SQL, envelopes, log
from strata.plans.registry import ntz, register, table

# ---- quality ------------------------------------------------------------------------------------------------

_ORDERS_SQL = """(SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus,
                           CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_custkey END AS o_custkey) FROM orders)"""
_CUSTOMERS_SQL = """(SELECT *, CASE WHEN c_nationkey = 4 THEN c_name ELSE c_name || '@' || lower(c_mktsegment)
                     || '.example.com' END AS email FROM customer)"""
_EMAIL = r"^[^@]+@[a-z.]+$"


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with NULL states and NULL customers."""
    return table(spark, sf, "orders").withColumns({
        "o_orderstatus": F.expr("nullif(o_orderstatus, 'P')"),
        "o_custkey": F.expr("CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_custkey END")})


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with an e-mail address; one nation's are no addresses."""
    address = F.concat("c_name", F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com"))
    return table(spark, sf, "customer").withColumn(
        "email", F.when(F.col("c_nationkey") == 4, F.col("c_name")).otherwise(address))


def _rules() -> list[Rule]:
    """As they stand in a configuration file."""
    return quality.rules_from([{"rule": rule, "severity": severity} for rule, severity in (
        ("not_null:o_orderkey", "critical"), ("not_null:o_orderstatus", "high"), ("unique:o_orderkey", "critical"),
        ("unique:o_custkey", "low"), ("range:o_totalprice:1000:450000", "medium"), ("pattern:o_orderpriority:^[1-5]-", "low"),
        ("timestamp_range:o_orderdate:1995-01-01..2001-06-30", "high"), ("not_null:o_comment", "low"))])


_SHORT = ["check_type", "column_name", "passed", "failed_rows"]


@register("dq_not_null", f"""
    SELECT 'not_null' AS check_type, unnest(['o_orderkey', 'o_orderstatus', 'o_custkey']) AS column_name,
           unnest([a = 0, b = 0, c = 0]) AS passed, unnest([a, b, c]) AS failed_rows
    FROM (SELECT count(*) FILTER (o_orderkey IS NULL) AS a, count(*) FILTER (o_orderstatus IS NULL) AS b,
                 count(*) FILTER (o_custkey IS NULL) AS c FROM {_ORDERS_SQL})
""")
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("not_null", c) for c in ("o_orderkey", "o_orderstatus", "o_custkey")]
    return quality.run_suite(_orders(spark, sf), rules).select(*_SHORT)


@register("dq_unique", f"""
    SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_custkey']) AS column_name, n AS total_rows,
           unnest([a, b, c]) AS unique_values, unnest([a = n, b = n, c = n]) AS passed
    FROM (SELECT count(*) AS n, count(DISTINCT o_orderkey) + max(CAST(o_orderkey IS NULL AS INTEGER)) AS a,
                 count(DISTINCT o_orderstatus) + max(CAST(o_orderstatus IS NULL AS INTEGER)) AS b,
                 count(DISTINCT o_custkey) + max(CAST(o_custkey IS NULL AS INTEGER)) AS c FROM {_ORDERS_SQL})
""")
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("unique", c) for c in ("o_orderkey", "o_orderstatus", "o_custkey")]
    return quality.run_suite(_orders(spark, sf), rules).select("column_name", "total_rows", "unique_values", "passed")


@register("dq_range", """
    SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS column_name, unnest([a, b, c]) AS failed_rows,
           unnest([a = 0, b = 0, c = 0]) AS passed
    FROM (SELECT count(*) FILTER (l_quantity < 2 OR l_quantity > 45) AS a, count(*) FILTER (l_discount > 0.09) AS b,
                 count(*) FILTER (l_tax < 0) AS c FROM lineitem)
""")
def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("range", "l_quantity", params={"low": 2, "high": 45}),
             Rule("range", "l_discount", params={"high": 0.09}), Rule("range", "l_tax", params={"low": 0})]
    return quality.run_suite(table(spark, sf, "lineitem"), rules).select("column_name", "failed_rows", "passed")


@register("dq_pattern", f"""
    SELECT 'email' AS column_name, count(*) FILTER (NOT regexp_matches(email, '{_EMAIL}')) AS failed_rows,
           count(*) FILTER (NOT regexp_matches(email, '{_EMAIL}')) = 0 AS passed FROM {_CUSTOMERS_SQL}
""")
def dq_pattern(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("pattern", "email", params={"regex": _EMAIL})]
    return quality.run_suite(_customers(spark, sf), rules).select("column_name", "failed_rows", "passed")


@register("dq_timestamp_range", """
    SELECT 'ts' AS column_name, count(*) FILTER (ts < TIMESTAMP '2024-01-02' OR ts > TIMESTAMP '2024-01-29')
           AS failed_rows, false AS passed FROM events
""")
def dq_timestamp_range(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("timestamp_range", "ts", params={"low": ntz("2024-01-02"), "high": ntz("2024-01-29")})]
    return quality.run_suite(table(spark, sf, "events"), rules).select("column_name", "failed_rows", "passed")


_SUITE_SQL = f"""
    WITH t AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus IS NULL) AS status_nulls,
        count(*) FILTER (o_orderkey IS NULL) AS key_nulls,
        count(DISTINCT o_orderkey) + max(CAST(o_orderkey IS NULL AS INTEGER)) AS keys,
        count(DISTINCT o_custkey) + max(CAST(o_custkey IS NULL AS INTEGER)) AS custs,
        count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 450000) AS prices,
        count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-5]-')) AS priorities,
        count(*) FILTER (o_orderdate < TIMESTAMP '1995-01-01' OR o_orderdate > TIMESTAMP '2001-06-30') AS dates
        FROM {_ORDERS_SQL})
    SELECT 'silver' AS layer, 'orders' AS table_name, check_type || ':' || column_name AS check_name, check_type,
           column_name, severity, coalesce(failed_rows = 0, false) AS passed, n AS total_rows, failed_rows,
           unique_values, error
    FROM (
        SELECT n, 'not_null' AS check_type, 'o_orderkey' AS column_name, 'critical' AS severity,
               key_nulls AS failed_rows, CAST(NULL AS BIGINT) AS unique_values, CAST(NULL AS VARCHAR) AS error FROM t
        UNION ALL SELECT n, 'not_null', 'o_orderstatus', 'high', status_nulls, NULL, NULL FROM t
        UNION ALL SELECT n, 'unique', 'o_orderkey', 'critical', n - keys, keys, NULL FROM t
        UNION ALL SELECT n, 'unique', 'o_custkey', 'low', n - custs, custs, NULL FROM t
        UNION ALL SELECT n, 'range', 'o_totalprice', 'medium', prices, NULL, NULL FROM t
        UNION ALL SELECT n, 'pattern', 'o_orderpriority', 'low', priorities, NULL, NULL FROM t
        UNION ALL SELECT n, 'timestamp_range', 'o_orderdate', 'high', dates, NULL, NULL FROM t
        UNION ALL SELECT n, 'not_null', 'o_comment', 'low', NULL, NULL, 'column o_comment not found' FROM t)
"""


@register("dq_suite", _SUITE_SQL)
def dq_suite(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_suite(_orders(spark, sf), _rules(), "silver", "orders")


@register("dq_score", f"""
    SELECT layer, table_name, count(*) AS checks, count(*) FILTER (passed) AS passed_checks,
           sum(CASE WHEN passed THEN w ELSE 0 END) * 100 / sum(w) AS score
    FROM (SELECT *, CASE severity WHEN 'critical' THEN 4.0::DOUBLE WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS w
          FROM ({_SUITE_SQL})) GROUP BY layer, table_name
""")
def dq_score(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score(dq_suite(spark, sf), weighted=True)


@register("dq_duplicates", """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_quarantine", """
    SELECT l_orderkey, l_linenumber, l_quantity, reasons FROM (
        SELECT *, concat_ws('; ', CASE WHEN l_quantity > 45 THEN 'range:l_quantity' END,
                            CASE WHEN l_discount > 0.09 THEN 'too generous' END,
                            CASE WHEN NOT regexp_matches(l_returnflag, '^[AN]$') THEN 'pattern:l_returnflag' END)
               AS reasons FROM lineitem) WHERE reasons <> ''
""")
def dq_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("range", "l_quantity", params={"high": 45}),
             Rule("range", "l_discount", params={"high": 0.09}, name="too generous"),
             Rule("pattern", "l_returnflag", params={"regex": "^[AN]$"})]
    bad = quality.quarantine(table(spark, sf, "lineitem"), rules)[1]
    return bad.select("l_orderkey", "l_linenumber", "l_quantity", F.array_join("reasons", "; ").alias("reasons"))


# ---- lineage ------------------------------------------------------------------------------------------------
#
# Each event is one finished run. Clicks load raw sources into clean tables, views those into business tables,
# purchases those into marts; sign-ups read and write two data sets each, and errors write marts back to raw sources,
# so the graph has diamonds and cycles.

_EDGES_SQL = """
    WITH RECURSIVE e AS (
        SELECT event_type AS t, user_id AS u, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
    edges AS (
        SELECT 'bronze.c' || (u % 20) AS source, 'silver.t' || (k % 10) AS target FROM e WHERE t = 'click'
        UNION SELECT 'silver.t' || (k % 10), 'gold.g' || (u % 5) FROM e WHERE t = 'view'
        UNION SELECT 'gold.g' || (u % 5), 'mart.m' || (k % 4) FROM e WHERE t = 'purchase'
        UNION SELECT 'mart.m' || (u % 4), 'bronze.c' || (u % 20) FROM e WHERE t = 'error'
        UNION SELECT 'bronze.s' || i, 'silver.s' || o
        FROM (SELECT unnest([u % 20, k % 20]) AS i, [k % 10, u % 10] AS os FROM e WHERE t = 'signup'), unnest(os) x(o))
"""


def lineage_log(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumns({
        "k": F.get_json_object("props", "$.k").cast("bigint"), "u": F.col("user_id")})

    def name(prefix: str, column: str, modulus: int):
        return F.concat(F.lit(prefix), F.pmod(column, F.lit(modulus)).cast("string"))

    def one(layer: str, prefix: str, column: str, modulus: int):
        return lineage.dataset(F.lit(layer), name(prefix, column, modulus))

    kind = F.col("event_type")
    raw, clean = one("bronze", "c", "u", 20), one("silver", "t", "k", 10)
    business, mart = one("gold", "g", "u", 5), one("mart", "m", "k", 4)
    inputs = (F.when(kind == "click", F.array(raw)).when(kind == "view", F.array(clean))
              .when(kind == "purchase", F.array(business)).when(kind == "error", F.array(one("mart", "m", "u", 4)))
              .otherwise(F.array(one("bronze", "s", "u", 20), one("bronze", "s", "k", 20))))
    outputs = (F.when(kind == "click", F.array(clean)).when(kind == "view", F.array(business))
               .when(kind == "purchase", F.array(mart)).when(kind == "error", F.array(raw))
               .otherwise(F.array(one("silver", "s", "k", 10), one("silver", "s", "u", 10))))
    run_id = F.md5(F.col("event_id").cast("string"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events.select(lineage.run_event(kind, inputs, outputs, stamp, run_id).alias("value"))


@register("lineage_edges", f"{_EDGES_SQL} SELECT DISTINCT source, target FROM edges")
def lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.edges(lineage_log(spark, sf))


@register("lineage_graph_counts", f"""{_EDGES_SQL}
    SELECT 'nodes:' || split_part(node, '.', 1) AS what, count(*) AS n
    FROM (SELECT source AS node FROM edges UNION SELECT target FROM edges) GROUP BY ALL
    UNION ALL SELECT 'edges', count(*) FROM edges
""")
def lineage_graph_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.graph_counts(lineage.edges(lineage_log(spark, sf)))


@register("lineage_impact", f"""{_EDGES_SQL},
    walk(start, node, depth) AS (
        SELECT DISTINCT source, source, 0 FROM edges WHERE starts_with(source, 'bronze')
        UNION SELECT start, target, depth + 1 FROM walk JOIN edges ON node = source WHERE depth < 9)
    SELECT start, node, min(depth) AS depth FROM walk WHERE depth > 0 AND node <> start GROUP BY start, node
""")
def lineage_impact(spark: SparkSession, sf: str) -> DataFrame:
    """Everything downstream of every raw source."""
    edges = checkpointed(lineage.edges(lineage_log(spark, sf)))
    starts = edges.filter(F.col("source").startswith("bronze")).select("source")
    return lineage.impact(edges, starts)


# ---- column protection --------------------------------------------------------------------------------------

def _mask_sql(c: str, visible: int) -> str:
    at = f"string_split({c}, '@')"
    return f"""CASE WHEN {c} IS NULL THEN NULL
        WHEN length({c}) <= {2 * visible} THEN repeat('*', length({c}))
        WHEN len({at}) = 2 AND {at}[2] <> '' THEN {at}[1][1:{visible}] || '***@' || {at}[2][1:1] || '***'
        ELSE {c}[1:{visible}] || '***' || right({c}, {visible}) END"""


@register("mask_pii", f"""
    SELECT c_custkey, {_mask_sql("email", 3)} AS email, {_mask_sql("c_mktsegment", 4)} AS c_mktsegment
    FROM {_CUSTOMERS_SQL}
""")
def mask_pii(spark: SparkSession, sf: str) -> DataFrame:
    out = protect.mask_columns(_customers(spark, sf), ["email"])
    return protect.mask_columns(out, ["c_mktsegment"], visible_chars=4).select("c_custkey", "email", "c_mktsegment")


# The texts as they are, with the customer's phone and number added so that every kind of value occurs.
_EXTRA_SQL = """' call +1 ' || CAST(200 + doc_id % 700 AS VARCHAR) || '-555-' || CAST(1000 + doc_id % 9000 AS VARCHAR)
    || ' id ' || CAST(100 + doc_id % 900 AS VARCHAR) || '-45-' || CAST(1000 + doc_id % 9000 AS VARCHAR)"""


@register("mask_pii_in_text", f"""
    SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text || {_EXTRA_SQL},
        '([A-Za-z0-9._%+-]{{1,3}})[A-Za-z0-9._%+-]*@([A-Za-z0-9])[A-Za-z0-9.-]*\\.[A-Za-z]{{2,}}', '\\1***@\\2***', 'g'),
        '\\b[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}\\b', '***-**-****', 'g'),
        '(\\+[0-9]{{1,3}}[ .-]?)?(\\([0-9]{{3}}\\) ?|[0-9]{{3}}[ .-])[0-9]{{3}}[ .-][0-9]{{4}}\\b', '***-***-****', 'g')
        AS text
    FROM documents
""")
def mask_pii_in_text(spark: SparkSession, sf: str) -> DataFrame:
    extra = _EXTRA_SQL.replace("VARCHAR", "STRING")
    documents = table(spark, sf, "documents").select("doc_id", F.expr(f"text || {extra}").alias("text"))
    return protect.mask_text_columns(documents, ["text"])


@register("encrypt_columns", "SELECT c_custkey, c_name, length(c_name) > 0 AS hidden FROM customer")
def encrypt_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Encrypted and decrypted again with one of two keys; ``hidden`` says that the stored text does not show the name.

    The key table stands for one that is read from a protected path.
    """
    keys = spark.createDataFrame([("old", bytearray(os.urandom(32))), ("new", bytearray(os.urandom(32)))], protect.KEYS)
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_name").alias("plain"))
    stored = protect.encrypt_columns(customers, ["c_name"], keys, "new")
    hidden = stored.withColumn("hidden", ~F.contains("c_name", F.col("plain")))
    return protect.decrypt_columns(hidden, ["c_name"], keys).drop("plain")


@register("pseudonymize_columns", """
    SELECT c_custkey, sha256(c_name) AS c_name, sha256('pepper' || c_mktsegment) AS c_mktsegment FROM customer
""")
def pseudonymize_columns(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    out = protect.pseudonymize_columns(customers, ["c_name"])
    return protect.pseudonymize_columns(out, ["c_mktsegment"], salt="pepper")


# ---- operational metrics ------------------------------------------------------------------------------------

@register("ingest_metrics", """
    SELECT 'src' || (user_id % 4) AS source, CASE event_type WHEN 'click' THEN 'bronze' WHEN 'view' THEN 'silver'
           ELSE 'gold' END AS layer, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
           count(*) AS batches, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS records,
           CAST(sum(length(props)) AS BIGINT) AS bytes, count(*) FILTER (event_type = 'error') AS errors
    FROM events GROUP BY ALL
""")
def ingest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Each event stands for one write: its source, layer, status, rows and bytes."""
    runs = table(spark, sf, "events").select(
        F.expr("concat('src', CAST(user_id % 4 AS STRING))").alias("source"),
        F.expr("CASE event_type WHEN 'click' THEN 'bronze' WHEN 'view' THEN 'silver' ELSE 'gold' END").alias("layer"),
        F.expr("CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END").alias("status"),
        F.get_json_object("props", "$.k").cast("bigint").alias("records"),
        F.length("props").cast("bigint").alias("bytes"))
    return opsmetrics.ingest_metrics(runs)


@register("message_metrics", f"""
    SELECT topic, NULL::DOUBLE AS le, status, count(*) AS messages
    FROM (SELECT *, CASE WHEN broken THEN 'failure' ELSE 'success' END AS status FROM ({ENVELOPES_SQL})) GROUP BY ALL
    UNION ALL SELECT topic, le, 'latency', count(*) FILTER (value / 100 <= le)
    FROM ({ENVELOPES_SQL}), (SELECT CAST(unnest([0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1, 2, 5]) AS DOUBLE) AS le)
    GROUP BY topic, le
    UNION ALL SELECT topic, NULL, 'latency', count(*) FROM ({ENVELOPES_SQL}) GROUP BY topic
""")
def message_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Messages by topic and status, and a latency histogram (the event value stands for the latency)."""
    sent = envelopes(spark, sf).select(
        ev.topic_for(F.col("event_type")).alias("topic"), F.when(F.col("broken"), "failure").otherwise("success").alias("status"),
        "value")
    return opsmetrics.message_report(sent, F.col("value") / 100)


_STORED = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
           "orders", "pages", "part", "region", "supplier")


@register("storage_metrics", " UNION ALL ".join(
    f"SELECT 'bronze' AS layer, '{t}' AS table_name, count(*) AS row_count, true AS has_bytes, true AS has_files FROM {t}"
    for t in _STORED))
def storage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return opsmetrics.storage_metrics(spark, {t: f"{sf}/{t}.parquet" for t in _STORED}, "bronze").select(
        "layer", "table_name", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"),
        (F.col("file_count") > 0).alias("has_files"))


@register("job_run_report", """
    SELECT job_name, status, count(*) AS runs, CAST(sum(seconds) AS BIGINT) AS total_seconds,
           max(seconds) AS longest_seconds, arg_max(error, run_id) FILTER (error IS NOT NULL) AS last_error
    FROM (SELECT 'job' || (user_id % 10) AS job_name, event_id AS run_id,
                 CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status,
                 CAST(json_extract_string(props, '$.k') AS BIGINT) AS seconds,
                 CASE WHEN event_type = 'error' THEN 'code ' || json_extract_string(props, '$.k') END AS error
          FROM events) GROUP BY job_name, status
""")
def job_run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Each event stands for one run; its k is the run time in seconds."""
    k = F.get_json_object("props", "$.k")
    failed = F.col("event_type") == "error"
    runs = table(spark, sf, "events").select(
        F.expr("concat('job', CAST(user_id % 10 AS STRING))").alias("job_name"), F.col("event_id").alias("run_id"),
        F.when(failed, "failed").otherwise("succeeded").alias("status"), F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=k.cast("decimal(18,6)"))).alias("completed_at"),
        F.when(failed, F.concat(F.lit("code "), k)).alias("error_message"))
    return opsmetrics.job_run_report(runs)


@register("audit_report", """
    SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS action, 'r' || (event_id % 3) AS resource_type,
           date_trunc('day', ts)::TIMESTAMP AS period, count(*) AS actions, min(ts) AS first_at, max(ts) AS last_at
    FROM events GROUP BY ALL
""")
def audit_report(spark: SparkSession, sf: str) -> DataFrame:
    entries = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("action"),
        F.expr("concat('r', CAST(event_id % 3 AS STRING))").alias("resource_type"), F.col("ts").alias("timestamp"))
    return opsmetrics.audit_report(entries)
