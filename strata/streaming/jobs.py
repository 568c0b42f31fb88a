"""Streaming jobs: raw events to the clean layer, windowed metrics, sinks that survive replays, monitoring.

Append-mode windows need a lateness. Unless told otherwise, events up to ten minutes late count; later ones are dropped
by the watermark and show up in the query progress as ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.cluster import checkpointed
from strata.operators import events, messages, quality
from strata.operators.gold import exact_sum
from strata.operators.silver import literal, portable, without_existing
from strata.operators.windows import neighbours

LATENESS = "10 minutes"
# Time between checkpoints of a running job.
CHECKPOINT_INTERVAL = "60 seconds"
WINDOW = "5 minutes"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None,
) -> DataFrame:
    """Files as a stream, oldest first. Files must be in time order when a trigger does not take them all."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def topic_events(log: DataFrame) -> DataFrame:
    """Envelopes of the messages of a log: values decoded and parsed, the message's time as event time ``ts``.

    A value that can't be decoded or parsed keeps its row, with NULL in the envelope, which validation rejects.
    """
    return events.parse(messages.decode(log, "string")).withColumn("ts", F.col("timestamp"))


def clean_events(
    stream: DataFrame, validated_at: Column, position: Sequence[str | Column] = (), spread: int = 16,
    lateness: str = LATENESS,
) -> DataFrame:
    """Validate envelopes, trim payload strings, stamp, and keep one row per event id.

    Needs a ``ts`` timestamp column. Duplicates are dropped twice: first within ``spread`` shares per id, dealt by the
    ``position`` columns of a row in its source, then per id. An id sent very often is thus thinned out in parallel
    before all of it meets in one task.
    """
    valid = events.validate(stream).filter(F.size("errors") == 0).drop("errors")
    cleansed = valid.withColumns({
        "payload": events.trim_payload_json(F.col("payload")),
        "validation_timestamp": validated_at,
    }).withWatermark("ts", lateness)
    if position:
        dealt = cleansed.withColumn("_share", F.pmod(F.xxhash64(*position), F.lit(spread)))
        cleansed = dealt.dropDuplicatesWithinWatermark(["event_id", "_share"]).drop("_share")
    return cleansed.dropDuplicatesWithinWatermark(["event_id"])


def window_metrics(
    stream: DataFrame, time_column: str = "ts", value: str = "value", by: Sequence[str] = ("event_type",),
    length: str = WINDOW, slide: str | None = None, scale: int | None = None,
) -> DataFrame:
    """Count, sum and mean per window and key; tumbling, or sliding when ``slide`` is given.

    The mean is over the values that are there; a window without any has no total and no mean. With ``scale``, the
    number of decimal places of the values, sums do not depend on the order of rows. On a stream the time column needs a watermark, and a window comes out once that has passed its end.
    """
    window = F.window(time_column, length, slide) if slide else F.window(time_column, length)
    grouped = stream.groupBy(window.alias("w"), *by).agg(
        F.count(F.lit(1)).alias("events"), F.count(value).alias("_values"),
        (F.sum(value) if scale is None else exact_sum(value, scale)).alias("total"))
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "events", "total",
        F.try_divide("total", "_values").alias("mean"))


def commit_batches(
    stream: DataFrame, path: str, checkpoint: str, outputs: Callable[[DataFrame], dict[str, DataFrame]],
    keys: Sequence[str] = (), within: str | None = None,
) -> DataStreamWriter:
    """Write each batch to one or several tables, each exactly once.

    Batch N of a checkpoint goes to ``<path>/<table>/run=<checkpoint's id>/batch_id=N`` and replaces only that
    directory, and its entry in ``<path>/commits`` follows when all tables are written. A batch that is run again after
    a failure lands on itself; readers use ``read_committed`` and see whole batches only.

    A lost checkpoint cuts batches anew, so nothing tells which rows are there already but the rows themselves: with
    ``keys`` each table leaves out rows whose key another checkpoint has committed; without, the job refuses a folder
    that another checkpoint has written.

    ``within`` is a further column of the key, a time or number that grows with the stream. Commits note the range of it
    that a batch holds, and only batches of other checkpoints whose range meets that of the new one are read. One job
    writes a folder at a time: what other checkpoints have committed is listed once, with the first batch.
    """
    known: dict[str, DataFrame] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = json.loads(session.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        if run not in known:
            known[run] = checkpointed(_commits(session, path).filter(F.col("run") != run))
        foreign = not known[run].isEmpty()
        if foreign and not keys:
            raise RuntimeError(f"{path} was written with another checkpoint; give keys to continue with this one")
        frames = outputs(batch)
        shared = len(frames) > 1 or foreign
        if shared:
            batch.persist()
        ranges = {}
        try:
            for name, frame in frames.items():
                folder = f"{path}/{name}/run={run}/batch_id={batch_id}"
                if foreign:
                    frame = _without_committed(frame, known[run], f"{path}/{name}", keys, within)
                frame.write.mode("overwrite").option("compression", "zstd").parquet(folder)
                if within in frame.columns:
                    ranges[name] = _extent(session.read.schema(frame.schema).parquet(folder), within)
        finally:
            if shared:
                batch.unpersist()
        noted = [F.struct(F.lit(low).cast("string").alias("low"), F.lit(high).cast("string").alias("high"), F.lit(nulls).alias("nulls"))
                 for low, high, nulls in ranges.values()]
        extents = F.map_from_arrays(F.array(*[F.lit(n) for n in ranges]), F.array(*noted)) if noted else F.lit(None)
        session.range(0, 1, 1, 1).select(
            F.lit(",".join(frames)).alias("tables"), extents.cast(_EXTENTS).alias("extents"),
        ).write.mode("overwrite").parquet(f"{path}/commits/run={run}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


_EXTENTS = "map<string,struct<low:string,high:string,nulls:boolean>>"
_COMMITS = f"tables string, extents {_EXTENTS}, run string, batch_id long"
# So many batches are read by their directories; more, by a join with the list of them.
_DIRECTORIES = 1000


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """Each finished batch: its checkpoint, number, tables and ranges; none while nothing has been written."""
    try:
        return spark.read.schema(_COMMITS).parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMITS)


def _extent(frame: DataFrame, column: str) -> Row:
    """Lowest and highest value of a column as the driver can hold them, and whether it is ever NULL."""
    kind = frame.schema[column].dataType
    ends = frame.agg(F.min(column).alias(column), F.max(column).alias("_high"),
                     F.coalesce(F.bool_or(F.col(column).isNull()), F.lit(False)).alias("nulls"))
    return ends.select(portable(column, kind).alias("low"), portable("_high", kind).alias("high"), "nulls").first()


def overlapping(commits: DataFrame, name: str, kind: T.DataType, extent: Row) -> DataFrame:
    """Commits whose part of a table can hold a value of this range; all that have noted no range."""
    noted = F.col("extents")[name]
    held = "bigint" if isinstance(kind, T.TimestampType) else kind
    ends = [F.lit(v).cast(held) for v in (extent["low"], extent["high"])]
    meets = (noted["low"].cast(held) <= ends[1]) & (noted["high"].cast(held) >= ends[0])
    return commits.where(noted.isNull() | meets | (noted["nulls"] & F.lit(extent["nulls"])))


def _without_committed(frame: DataFrame, commits: DataFrame, path: str, keys: Sequence[str], within: str | None) -> DataFrame:
    """Rows of a batch that the given commits don't hold."""
    name = path.rsplit("/", 1)[1]
    commits = commits.where(F.array_contains(F.split("tables", ","), name))
    columns, own = list(keys), F.lit(True)
    if within in frame.columns:
        extent, kind = _extent(frame, within), frame.schema[within].dataType
        commits = overlapping(commits, name, kind, extent)
        columns = list(dict.fromkeys([*keys, within]))
        own = F.col(within).between(literal(extent["low"], kind), literal(extent["high"], kind))
        own = own | F.col(within).isNull() if extent["nulls"] else own
    found = commits.select("run", "batch_id").limit(_DIRECTORIES + 1).collect()
    if not found:
        return frame
    reader = frame.sparkSession.read.schema(T.StructType([*[frame.schema[c] for c in columns], *_PLACE])).option("basePath", path)
    if len(found) <= _DIRECTORIES:
        held = reader.parquet(*[f"{path}/run={r.run}/batch_id={r.batch_id}" for r in found])
    else:
        held = reader.parquet(path).join(commits, ["run", "batch_id"], "left_semi")
    return without_existing(frame, held.where(own), columns)


_PLACE = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]


def _read(spark: SparkSession, path: str, name: str, commits: DataFrame) -> DataFrame:
    return (spark.read.parquet(f"{path}/{name}").withColumn("run", F.col("run").cast("string"))
            .join(commits, ["run", "batch_id"], "left_semi").drop("run", "batch_id"))


def read_committed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of finished batches. The list of finished batches is metadata and small."""
    return _read(spark, path, name, _commits(spark, path))


def route_batches(failed_at: Column) -> Callable[[DataFrame], dict[str, DataFrame]]:
    """Outputs of a message stream with ``errors``: valid messages, and dead letters."""

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        good, dead = events.split_dead_letters(batch, failed_at)
        return {"valid": good, "dead_letters": dead}

    return split


def quality_batches(
    rules: Sequence[quality.Rule], layer: str, table: str,
) -> Callable[[DataFrame], dict[str, DataFrame]]:
    """Outputs of a monitored stream: one result row per rule and batch, and the failed ones as alerts."""

    def check(batch: DataFrame) -> dict[str, DataFrame]:
        results = quality.run_suite(batch, rules, layer, table)
        return {"results": results, "alerts": results.filter(~F.col("passed"))}

    return check


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_continuously(writer: DataStreamWriter) -> StreamingQuery:
    """Run until stopped, with a checkpoint every minute."""
    return writer.trigger(processingTime=CHECKPOINT_INTERVAL).start()


def anomaly_flags(
    metrics: DataFrame, by: Sequence[str], order: str, value: str, split: Column, history: int = 12, bound: float = 3.0,
) -> DataFrame:
    """Windows whose value lies more than ``bound`` standard deviations from the mean of the ``history`` before it.

    No flag until the history is full, or when it does not vary.
    """
    scored = neighbours(metrics, by, [order], split, before=history, columns={
        "history": lambda w: F.count(value).over(w.rowsBetween(-history, -1)),
        "expected": lambda w: F.avg(value).over(w.rowsBetween(-history, -1)),
        "spread": lambda w: F.stddev_samp(value).over(w.rowsBetween(-history, -1))})
    z = F.when((F.col("history") == history) & (F.col("spread") > 0),
               (F.col(value) - F.col("expected")) / F.col("spread"))
    return scored.withColumn("z", z).withColumn("anomaly", F.coalesce(F.abs("z") > bound, F.lit(False)))


def anomaly_stream(
    metrics: DataFrame, by: Sequence[str], order: str, value: str, history: int = 12, bound: float = 3.0,
) -> DataFrame:
    """``anomaly_flags`` as a running job, over closed windows that another stream has landed: same rows and columns,
    wherever the triggers cut. (Spark doesn't allow a state of one's own behind an aggregate in the same stream.)

    The state of a key is the ring of its last ``history`` values. A trigger brings the windows of a key in any order,
    but all of them after those of earlier triggers: the watermark closes them in order, and files come oldest first.
    What a trigger brings for one key meets in one task: a row for each window, whatever the number of events. NULL and
    NaN are both a missing value.
    """
    kinds = {"history": T.LongType(), "expected": T.DoubleType(), "spread": T.DoubleType(), "z": T.DoubleType(),
             "anomaly": T.BooleanType()}
    schema = T.StructType([*metrics.schema.fields, *[T.StructField(n, k) for n, k in kinds.items()]])

    def flag(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        import numpy as np
        import pandas as pd

        rows = pd.concat(list(frames)).sort_values(order, ignore_index=True)
        ring = list(state.get[0]) if state.exists else []
        scores = []
        for now in rows[value].astype("float64"):
            seen = np.array([v for v in ring if v == v])
            count, mean, spread, z = len(seen), None, None, None
            if count:
                # About the first value, so that equal values have no spread at all.
                mean = float(seen[0] + (seen - seen[0]).mean())
            if count > 1:
                spread = float((seen - seen[0]).std(ddof=1))
            if count == history and spread > 0 and now == now:
                z = (now - mean) / spread
            scores.append((count, mean, spread, z, z is not None and abs(z) > bound))
            ring = [*ring, float(now)][-history:]
        state.update((ring,))
        for i, name in enumerate(kinds):
            rows[name] = [s[i] for s in scores]
        yield rows

    return metrics.groupBy(*by).applyInPandasWithState(
        flag, schema, "ring array<double>", "append", GroupStateTimeout.NoTimeout)
