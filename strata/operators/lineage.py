"""Lineage: run events, dataset edges, graph size and impact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.cluster import checkpointed
from strata.operators.plan import computed_once

# Event type and job namespace of a tracked transformation.
COMPLETE = "COMPLETE"
JOB_NAMESPACE = "dataplatform"

_DATASET = T.StructType([T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType())])
RUN_EVENT = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("eventTime", T.StringType()),
    T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
    T.StructField("job", _DATASET),
    T.StructField("inputs", T.ArrayType(_DATASET)),
    T.StructField("outputs", T.ArrayType(_DATASET)),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def dataset(namespace: Column, name: Column) -> Column:
    return F.struct(namespace.alias("namespace"), name.alias("name"))


def run_event(
    job: Column, inputs: Column, outputs: Column, event_time: Column, run_id: Column, metadata: Column | None = None,
) -> Column:
    """Event JSON of one finished job run."""
    return F.to_json(F.struct(
        F.lit(COMPLETE).alias("eventType"), event_time.alias("eventTime"), F.struct(run_id.alias("runId")).alias("run"),
        dataset(F.lit(JOB_NAMESPACE), job).alias("job"), inputs.alias("inputs"), outputs.alias("outputs"),
        (metadata if metadata is not None else F.create_map().cast("map<string,string>")).alias("metadata")))


def edges(log: DataFrame, value: str = "value") -> DataFrame:
    """Distinct dataset-to-dataset edges of the finished runs in an event log."""
    event = computed_once(log.select(value), F.from_json(value, RUN_EVENT)).filter(F.col("eventType") == COMPLETE)
    # Runs repeat: keep one row per input and output list before they are paired up.
    lists = event.select("inputs", "outputs").distinct()
    pairs = lists.select(F.explode("inputs").alias("i"), "outputs").select("i", F.explode("outputs").alias("o"))
    node = lambda side: F.concat_ws(".", f"{side}.namespace", f"{side}.name")
    return pairs.select(node("i").alias("source"), node("o").alias("target")).distinct()


def graph_counts(edge_frame: DataFrame) -> DataFrame:
    """Nodes per namespace, and edges, in one pass over the edges."""
    ends = edge_frame.select(F.explode(F.array("source", "target")).alias("node")).distinct()
    kind = F.concat(F.lit("nodes:"), F.substring_index("node", ".", 1))
    nodes = ends.groupBy(kind.alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return nodes.union(edge_frame.agg(F.lit("edges").alias("what"), F.count(F.lit(1)).alias("n")))


def impact(edge_frame: DataFrame, starts: DataFrame, upstream: bool = False, max_depth: int | None = None) -> DataFrame:
    """Everything that depends on each start node (or that it depends on), with the shortest distance.

    Breadth first: one join per level, and nodes already reached are not visited again, so cycles end. Each level is
    checkpointed, which keeps plans short and survives lost executors.
    """
    source, target = ("target", "source") if upstream else ("source", "target")
    links = checkpointed(edge_frame.select(F.col(source).alias("node"), F.col(target).alias("next")).distinct())
    frontier = starts.select(F.col(starts.columns[0]).alias("start")).distinct().select(
        "start", F.col("start").alias("node"), F.lit(0).alias("depth"))
    reached = frontier = checkpointed(frontier)
    depth = 0
    while max_depth is None or depth < max_depth:
        depth += 1
        found = frontier.join(links, "node").select("start", F.col("next").alias("node")).distinct()
        fresh = checkpointed(found.join(reached, ["start", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            break
        reached, frontier = reached.union(fresh), fresh
    return reached.filter("depth > 0")
