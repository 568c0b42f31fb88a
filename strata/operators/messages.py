"""Kafka-shaped message logs: encode, decode, partition, offsets, lag, compaction, retention.

A log has the columns of the Kafka source: ``key``, ``value`` (binary), ``topic``, ``partition``, ``offset``,
``timestamp`` and ``headers`` (array of key and binary value). Offsets rise within a partition and may have gaps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.cluster import checkpointed

FORMATS = ("json", "string", "bytes")


def encode(
    df: DataFrame, value: str | Sequence[str], key: str | None = None,
    headers: Sequence[str] = (), value_format: str = "json", json_text: bool = False,
) -> DataFrame:
    """Add binary ``key`` and ``value`` and the ``headers`` array.

    ``value`` names one column, or several to be packed into a JSON object.
    """
    if value_format not in FORMATS:
        raise ValueError(f"value_format must be one of {FORMATS}")
    if not isinstance(value, str):
        body = F.to_json(F.struct(*value))
    elif value_format == "json" and not json_text:
        wrapped = F.to_json(F.array(value))
        body = wrapped.substr(F.lit(2), F.length(wrapped) - 2)
    else:
        body = F.col(value)
    header = F.array(*[F.struct(F.lit(h).alias("key"), F.col(h).cast("string").cast("binary").alias("value"))
                       for h in headers]) if headers else F.lit(None).cast("array<struct<key:string,value:binary>>")
    return df.withColumns({
        "key": (F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")),
        "value": body.cast("binary") if value_format == "bytes" else body.cast("string").cast("binary"),
        "headers": header,
    })


def decode(df: DataFrame, value_format: str = "json") -> DataFrame:
    """Text key and value, headers as a map, and per row what could not be decoded.

    A value that is no JSON, or no UTF-8, keeps its row and gets a ``decode_error``. With ``json`` the value
    stays JSON text; parse it with a schema afterwards.
    """
    if value_format not in FORMATS:
        raise ValueError(f"value_format must be one of {FORMATS}")
    raw = F.col("value")
    text = F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
    error = F.when(raw.isNotNull() & text.isNull(), F.lit("value is not UTF-8"))
    if value_format == "json":
        error = F.coalesce(error, F.when(text.isNotNull() & F.try_parse_json(text).isNull(),
                                         F.lit("value is not JSON")))
    names = F.col("headers.key")
    # A header sent twice keeps its last value; most messages send none twice.
    last = F.filter("headers", lambda h, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), h["key"]))
    unique = F.when(F.size(F.array_distinct(names)) < F.size(names), last).otherwise(F.col("headers"))
    header_map = F.map_from_arrays(unique["key"], unique["value"]).cast("map<string,string>")
    columns = {
        "key": F.col("key").cast("string"),
        "headers": F.coalesce(header_map, F.create_map().cast("map<string,string>")),
    }
    if value_format != "bytes":
        columns["value"] = text
        columns["decode_error"] = error
    return df.withColumns(columns)


def bucket_of(key: Column, partitions: int) -> Column:
    """Partition number of a key, stable across engines: the first 28 bits of its md5, modulo ``partitions``."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("long") % partitions).cast("int")


def partition_by_key(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Add ``partition``; equal keys get equal partitions."""
    return df.withColumn("partition", bucket_of(F.col(key), partitions))


def ordered_for_write(df: DataFrame, tasks: int, spread: int = 1) -> DataFrame:
    """Rows laid out for sending: one task sends a partition, in order of its offsets.

    ``spread`` deals the keys of each partition to so many tasks, for a partition that holds most of the log: the order
    is then kept per key, as messages of a key always stay in one task.
    """
    order = ["topic", "partition", "offset"]
    share = F.pmod(F.xxhash64("key"), F.lit(spread))
    return df.repartition(tasks, "topic", "partition", share).sortWithinPartitions(*order)


# Positions and ranges have a row per partition of a topic; up to so many of them go to all tasks.
_PARTITIONS = 100_000


def _per_partition(rows: DataFrame) -> DataFrame:
    """Broadcast where there are few enough, so that the log is not shuffled on its few partitions."""
    rows = checkpointed(rows)  # often made by a scan of a log: once for the count and the join
    return F.broadcast(rows) if rows.limit(_PARTITIONS + 1).count() <= _PARTITIONS else rows


def select_topics(df: DataFrame, topics: Sequence[str] | None = None, pattern: str | None = None) -> DataFrame:
    """Messages of the listed topics, or of the topics whose whole name matches the pattern."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or pattern")
    return df.filter(F.col("topic").isin(list(topics)) if topics is not None
                     else F.col("topic").rlike(f"^(?:{pattern})$"))


def offset_range(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Replay: messages with ``from_offset <= offset < to_offset`` of their partition; NULL is an open end."""
    out = df.join(_per_partition(ranges), ["topic", "partition"])
    return out.filter(
        (F.col("from_offset").isNull() | (F.col("offset") >= F.col("from_offset")))
        & (F.col("to_offset").isNull() | (F.col("offset") < F.col("to_offset")))
    ).drop("from_offset", "to_offset")


_SHARES = 16
# Up to this rank Spark keeps the first rows of a window before it shuffles.
_KEPT_EARLY = 1000


def _first_blocks(log: DataFrame, limit: int) -> DataFrame:
    """Messages of each partition up to the block of ``limit`` offsets that holds its ``limit``-th message.

    Blocks are counted before anything is shuffled, so what is left are less than twice ``limit`` messages of each.
    """
    place = Window.partitionBy("topic", "partition").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    block = F.coalesce(F.col("offset") - F.pmod("offset", F.lit(limit)), F.lit(-(1 << 63)))
    counts = log.groupBy("topic", "partition", block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    needed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(place), F.lit(0))).filter(F.col("_before") < limit)
    last = needed.groupBy(F.col("topic").alias("_topic"), F.col("partition").alias("_partition")).agg(
        F.max("_block").alias("_last"))
    return log.join(_per_partition(last), F.col("topic").eqNullSafe(F.col("_topic"))
                    & F.col("partition").eqNullSafe(F.col("_partition")) & (block <= F.col("_last"))).drop(
        "_topic", "_partition", "_last")


def next_batch(df: DataFrame, positions: DataFrame | None = None, limit: int = 500) -> DataFrame:
    """The next ``limit`` messages of each partition, from ``position`` (0 when a partition has none).

    A partition is cut to ``limit`` rows in shares of its offsets first, so the task that picks the batch never sees
    more than ``_SHARES`` times that many. Above a limit of ``_KEPT_EARLY``, where Spark would shuffle all messages for
    that, offsets are counted in blocks first, and only the blocks of the batch are read on.
    """
    log = df
    if positions is not None:
        log = df.join(_per_partition(positions), ["topic", "partition"], "left").filter(
            F.col("offset") >= F.coalesce("position", F.lit(0))).drop("position")
    if limit > _KEPT_EARLY:
        log = _first_blocks(log, limit)
    log = log.withColumn("_share", F.pmod(F.xxhash64("offset"), F.lit(_SHARES)))
    for by in (["topic", "partition", "_share"], ["topic", "partition"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("offset"))
        log = log.withColumn("_rn", place).filter(F.col("_rn") <= limit).drop("_rn")
    return log.drop("_share")


def watermarks(df: DataFrame) -> DataFrame:
    """Earliest offset and next offset of every partition."""
    return df.groupBy("topic", "partition").agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest"))


def commit_positions(processed: DataFrame, group: str) -> DataFrame:
    """Position to commit after processing: last processed offset plus one."""
    return processed.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("position")).select(
        F.lit(group).alias("group_id"), "topic", "partition", "position")


def consumer_lag(marks: DataFrame, commits: DataFrame) -> DataFrame:
    """Messages still to read, for every partition of the topics a group reads; no commit means position 0.

    ``marks`` are the log's ``watermarks``: a row per partition.
    """
    subscribed = commits.select("group_id", "topic").distinct()
    joined = marks.join(subscribed, "topic").join(commits, ["group_id", "topic", "partition"], "left")
    position = F.coalesce("position", F.lit(0))
    return joined.select("group_id", "topic", "partition", position.alias("position"), "latest",
                         (F.col("latest") - position).alias("lag"))


def describe_topics(df: DataFrame) -> DataFrame:
    """Partitions and messages of every topic: counted per partition first, then per topic."""
    per_partition = df.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"))
    return per_partition.groupBy("topic").agg(
        F.count(F.lit(1)).alias("num_partitions"), F.sum("n").alias("messages"))


def compact(df: DataFrame) -> DataFrame:
    """Last message of every key per topic; a key whose last value is NULL is gone."""
    window = Window.partitionBy("topic", "key").orderBy(F.desc("offset"), F.desc("partition"))
    latest = df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
    return latest.filter(F.col("value").isNotNull())


def retain(df: DataFrame, retention_ms: Mapping[str, int], as_of: Column) -> DataFrame:
    """Messages no older than their topic's retention at ``as_of``; unlisted topics keep everything."""
    if not retention_ms:
        return df
    limits = F.create_map(*[F.lit(x) for pair in retention_ms.items() for x in pair])
    limit = F.try_element_at(limits, F.col("topic"))
    oldest = as_of - F.make_dt_interval(secs=(limit / 1000).cast("decimal(18,6)"))
    return df.filter(limit.isNull() | (F.col("timestamp") >= oldest))
