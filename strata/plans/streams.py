"""Streaming queries: the given events as a file stream, run until everything available is processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.cluster import scratch_path
from strata.operators import events, messages
from strata.operators.quality import Rule
from strata.plans.inputs import ENVELOPES_SQL, envelopes, log_of
from strata.plans.registry import ntz, register, table
from strata.streaming import jobs
from strata.streaming.metrics import RunMetrics

STAMP = "2024-02-01T00:00:00.000000Z"


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    # A file source wants a directory or a pattern; this pattern matches the table whether it is one file or many.
    return jobs.read_stream(spark, f"{sf}/events.parque[t]", table(spark, sf, "events").schema)


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a watermark; event time must carry a time zone."""
    return _stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", jobs.LATENESS)


def _to_parquet(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    jobs.run_available(writer)
    return spark.read.schema(stream.schema).parquet(path)


@register("stream_bronze_to_silver", f"""
    SELECT eid AS event_id, etype AS event_type, stamp AS event_timestamp, source AS source_system,
           CASE WHEN etype = 'system_event' THEN 'code ' || k END AS message,
           CASE WHEN etype = 'transaction' THEN value END AS amount, '{STAMP}' AS validation_timestamp
    FROM ({ENVELOPES_SQL}) WHERE errors = '' AND NOT broken
""")
def stream_bronze_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Every message of the log is delivered twice; unreadable and invalid ones are dropped, the rest comes out once."""
    delivered = log_of(_stream(spark, sf))
    arrived = jobs.topic_events(delivered.union(delivered))
    clean = jobs.clean_events(arrived, F.lit(STAMP), ["topic", "partition", "offset"])
    path, checkpoint = scratch_path(spark, "silver"), scratch_path(spark, "silver-checkpoint")
    jobs.run_available(jobs.commit_batches(clean, path, checkpoint, lambda batch: {"events": batch}))
    stored = jobs.read_committed(spark, path, "events")
    return stored.select(
        "event_id", "event_type", "event_timestamp", "source_system",
        F.get_json_object("payload", "$.message").alias("message"),
        F.get_json_object("payload", "$.amount").cast("double").alias("amount"), "validation_timestamp")


@register("stream_payload_trim", f"""
    SELECT src_id, CASE WHEN NOT bad_payload THEN 'code ' || k END AS message,
           CASE WHEN NOT bad_payload THEN event_type END AS event_name, 4 AS payload_keys
    FROM ({ENVELOPES_SQL}) WHERE etype = 'system_event' AND NOT bad_payload
""")
def stream_payload_trim(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.from_json("payload", "map<string,string>")
    system = envelopes(spark, sf).filter("event_type = 'system_event'").filter(F.col("payload").startswith("{"))
    trimmed = system.withColumn("p", events.trim_payload(payload))
    return trimmed.select("src_id", F.col("p")["message"].alias("message"), F.col("p")["event_name"].alias("event_name"),
                          F.size("p").alias("payload_keys"))


_CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"
# Values with four places, some of them missing.
_FINE_SQL = "(SELECT * REPLACE (CASE WHEN event_id % 11 <> 0 THEN value + (event_id % 97) / 10000.0::DOUBLE END AS value) FROM events)"
_METRICS = """event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(28,4))) AS DOUBLE) AS total,
    CAST(sum(CAST(value AS DECIMAL(28,4))) AS DOUBLE) / nullif(count(value), 0) AS mean"""


def _fine(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.when(F.col("event_id") % 11 != 0, F.col("value") + (F.col("event_id") % 97) / 10000.0))


def _ntz_windows(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register("stream_tumbling_5min", f"""
    SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
                          time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, {_METRICS}
                   FROM {_FINE_SQL} GROUP BY ALL) WHERE {_CLOSED}
""")
def stream_tumbling_5min(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that the watermark has closed."""
    return _ntz_windows(_to_parquet(spark, jobs.window_metrics(_fine(_timed(spark, sf)), scale=4), "tumbling"))


@register("stream_sliding", f"""
    SELECT * FROM (SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, {_METRICS}
                   FROM (SELECT *, unnest([time_bucket(INTERVAL 5 MINUTE, ts),
                                           time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS window_start
                         FROM {_FINE_SQL}) GROUP BY window_start, event_type) WHERE {_CLOSED}
""")
def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Ten-minute windows every five minutes, those the watermark has closed."""
    sliding = jobs.window_metrics(_fine(_timed(spark, sf)), length="10 minutes", slide="5 minutes", scale=4)
    return _ntz_windows(_to_parquet(spark, sliding, "sliding"))


@register("stream_exactly_once_sink", "SELECT event_id, ts, event_type, value FROM events")
def stream_exactly_once_sink(spark: SparkSession, sf: str) -> DataFrame:
    """A stream over several files runs file by file, loses its checkpoint, and runs again two files at a time onto the
    same table; every event is there once."""
    path, source = scratch_path(spark, "exactly-once"), scratch_path(spark, "exactly-once-files")
    table(spark, sf, "events").select("event_id", "ts", "event_type", "value").repartition(5, "event_id").write.parquet(source)
    schema = spark.read.parquet(source).schema
    for attempt in (1, 2):
        checkpoint = scratch_path(spark, f"exactly-once-checkpoint-{attempt}")
        stream = jobs.read_stream(spark, source, schema, attempt)
        jobs.run_available(jobs.commit_batches(stream, path, checkpoint, lambda batch: {"events": batch}, ["event_id"], "ts"))
    return jobs.read_committed(spark, path, "events")


@register("stream_dead_letter", f"""
    SELECT CASE WHEN errors <> '' OR broken THEN 'dead-letter-queue' ELSE topic END AS topic,
           CASE WHEN errors <> '' OR broken THEN topic END AS original_topic, count(*) AS messages,
           CAST(sum(src_id) AS BIGINT) AS offsets
    FROM ({ENVELOPES_SQL}) GROUP BY ALL
""")
def stream_dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    """Messages in, valid ones to one table and dead letters to another, from the same batch."""
    checked = events.validate(events.parse(messages.decode(log_of(_stream(spark, sf)), "string")))
    path, checkpoint = scratch_path(spark, "letters"), scratch_path(spark, "letters-checkpoint")
    jobs.run_available(jobs.commit_batches(checked, path, checkpoint, jobs.route_batches(ntz("2024-02-01"))))
    valid = jobs.read_committed(spark, path, "valid").select(
        "topic", F.lit(None).cast("string").alias("original_topic"), "offset")
    dead = jobs.read_committed(spark, path, "dead_letters").select(
        "topic", "original_topic", F.col("original_offset").alias("offset"))
    return valid.union(dead).groupBy("topic", "original_topic").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("offset").alias("offsets"))


@register("stream_quality_monitor", """
    SELECT 'results' AS kind, check_name, passed, failed_rows, total_rows FROM (
        SELECT unnest(['not_null:event_id', 'range:value', 'pattern:event_type']) AS check_name,
               unnest([true, a = 0, b = 0]) AS passed, unnest([0, a, b]) AS failed_rows, n AS total_rows
        FROM (SELECT count(*) AS n, count(*) FILTER (value > 200) AS a, count(*) FILTER (event_type = 'error') AS b
              FROM events))
    UNION ALL SELECT 'alerts', 'range:value', false, count(*) FILTER (value > 200), count(*) FROM events
    UNION ALL SELECT 'alerts', 'pattern:event_type', false, count(*) FILTER (event_type = 'error'), count(*) FROM events
""")
def stream_quality_monitor(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("not_null", "event_id", "critical"), Rule("range", "value", params={"high": 200}),
             Rule("pattern", "event_type", "low", {"regex": "^(click|view|signup|purchase)$"})]
    path, checkpoint = scratch_path(spark, "monitor"), scratch_path(spark, "monitor-checkpoint")
    jobs.run_available(jobs.commit_batches(_stream(spark, sf), path, checkpoint,
                                           jobs.quality_batches(rules, "bronze", "events")))
    columns = ["check_name", "passed", "failed_rows", "total_rows"]
    results, alerts = (jobs.read_committed(spark, path, t).select(F.lit(t).alias("kind"), *columns)
                       for t in ("results", "alerts"))
    return results.union(alerts)


def _anomalies_sql(closed: str = "true") -> str:
    return f"""
    SELECT event_type, window_start, total, round(z, 6) AS z, coalesce(abs(z) > 2, false) AS anomaly FROM (
        SELECT *, CASE WHEN count(*) OVER h = 12 AND stddev_samp(total) OVER h > 0
                       THEN (total - avg(total) OVER h) / stddev_samp(total) OVER h END AS z
        FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, window_start + INTERVAL 1 HOUR AS window_end,
                     CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL)
        WHERE {closed}
        WINDOW h AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
    """


@register("anomaly_flags", _anomalies_sql())
def anomaly_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Hours whose total is far from the twelve before."""
    hourly = jobs.window_metrics(table(spark, sf, "events"), length="1 hour", scale=2)
    flagged = jobs.anomaly_flags(hourly, ["event_type"], "window_start", "total", F.to_date("window_start"), bound=2.0)
    return flagged.select("event_type", "window_start", "total", F.round("z", 6).alias("z"), "anomaly")


@register("anomaly_stream", _anomalies_sql(_CLOSED))
def anomaly_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same by running jobs: one lands the hours as the watermark closes them, the other flags what is landed."""
    hourly = jobs.window_metrics(_timed(spark, sf), length="1 hour", scale=2).select("event_type", "window_start", "total")
    path = scratch_path(spark, "hourly")
    jobs.run_available(hourly.writeStream.format("parquet").option("path", path)
                       .option("checkpointLocation", scratch_path(spark, "hourly-checkpoint")))
    closed = jobs.read_stream(spark, path, hourly.schema)
    flagged = jobs.anomaly_stream(closed, ["event_type"], "window_start", "total", bound=2.0)
    return _to_parquet(spark, flagged, "anomalies").select(
        "event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "total",
        F.round("z", 6).alias("z"), "anomaly")


@register("stream_run_metrics", """
    SELECT 2 AS triggers, count(*) + count(*) FILTER (event_id % 10 = 0) AS input_rows,
           count(*) FILTER (event_id % 10 = 0 AND ts <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE) AS late_rows
    FROM events
""")
def stream_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """All events, then a tenth of them again: those behind the watermark are late, and the landed metrics count them."""
    source, path, check, landed = (scratch_path(spark, f"run-metrics-{n}") for n in ("files", "out", "check", "landed"))
    found = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    with RunMetrics(spark, landed) as metrics:
        for part in (found, found.filter("event_id % 10 = 0")):
            part.write.mode("append").parquet(source)
            # Each run ends with a trigger without rows, which moves the watermark for the next.
            stream = jobs.read_stream(spark, source, found.schema).withWatermark("ts", jobs.LATENESS)
            metrics.landed(jobs.run_available(stream.dropDuplicatesWithinWatermark(["event_id"]).writeStream.format("parquet")
                                              .option("path", path).option("checkpointLocation", check)))
    return spark.read.parquet(landed).filter("input_rows > 0").agg(
        F.count(F.lit(1)).cast("int").alias("triggers"), F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))
