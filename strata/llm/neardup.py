"""Near-duplicate vectors by NN-descent.

A graph keeps the best neighbours of each vector. It begins with vectors on the same side of some random planes, and
each round compares the neighbours of every vector, both those it has and those that have it, with one another: the
neighbours of a neighbour are good candidates. Pairs at the threshold become links, whether or not the lists have room
for them. A list that is full of links is saturated, so it may miss some: components that may hold such lists are compared
with each other, unless their distance rules links out, and lists of linked vectors are enlarged to all vectors that the
links reach, both in blocks. An audit compares a sample of vectors with all others and asks for more rounds while recall
is too low.

Equal vectors are one node from the beginning. All similarities are taken in double precision.
"""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from strata.cluster import checkpointed
from strata.llm.components import components
from strata.llm.storage import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_log = logging.getLogger(__name__)
THRESHOLD = 0.9
NEIGHBOURS = 10
# The graph begins with so many tables of planes; cells hold about so many vectors, groups to compare no more than that.
TABLES, CELL, GROUP = 8, 16, 64
ROUNDS, MOST_ROUNDS = 2, 6
# The audit compares so many vectors, and as many that are known to have links, with all others.
AUDITED, RECALL = 512, 0.98
_AUDIT_SEED = 1 << 20
_BLOCK, _WIDE = 512, 2048
# Vectors with a link are no further apart than this angle, with room for rounding.
_REACH = float(np.arccos(THRESHOLD)) + 1e-6


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not NULL or empty, no component NULL or not finite, not all zero."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision; scaled by their largest component first, so that nothing overflows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = batch.column("vec").value_lengths().to_numpy()
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def _cells(bits: int, tables: int, seed: int) -> Callable:
    """Each vector once for each table, with the cell that the signs of its projections name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_length(batch):
                x = _matrix(part.column("vec"))
                planes = np.random.default_rng([seed, x.shape[1]]).normal(size=(x.shape[1], tables * bits))
                signs = (x @ planes > 0).reshape(len(x), tables, bits)
                cells = (signs * (1 << np.arange(bits))).sum(axis=2) + (x.shape[1] << 40)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells[:, t] * tables + t), part.column("node"), part.column("vec")],
                        ["centre", "node", "vec"])

    return run


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all that the links of a matrix connect, fewer than its rows."""
    left, a, b = near.any(axis=1), [], []
    for first in np.flatnonzero(left):
        reached = [first] if left[first] else []
        left[first] = False
        while reached:
            i = reached.pop()
            new = np.flatnonzero(near[i] & left)
            left[new] = False
            a += [i] * len(new)
            b += new.tolist()
            reached += new.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _compare(rows: pa.Table) -> pa.Table:
    """The best partners of each member of a group, as far as they are better than the worst it has; and links, whatever
    the members have, that connect all that the links of the group connect."""
    nodes = rows.column("node").to_numpy()
    nodes, first = np.unique(nodes, return_index=True)
    x = _matrix(rows.column("vec").take(pa.array(first)))
    floor = rows.column("floor").to_numpy()[first]
    scores = x @ x.T
    np.fill_diagonal(scores, -2)
    k = min(NEIGHBOURS, len(nodes) - 1)
    if k < 1:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    values = np.take_along_axis(scores, best, axis=1)
    keep = values > floor[:, None]
    a, b = _forest(scores >= THRESHOLD)
    return pa.table({"a": np.concatenate([np.repeat(nodes, keep.sum(axis=1)), nodes[a]]),
                     "b": np.concatenate([nodes[best[keep]], nodes[b]]),
                     "score": np.concatenate([values[keep], scores[a, b]])})


def _grouped(members: DataFrame) -> DataFrame:
    """Compare the members of each centre, in groups of bounded size."""
    crowded = members.groupBy("centre").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > GROUP)
    group = F.pmod(F.xxhash64("node", "centre"), F.coalesce(F.ceil(F.col("size") / GROUP), F.lit(1)))
    return (members.join(crowded, "centre", "left").withColumn("group", group).drop("size")
            .groupBy("centre", "group").applyInArrow(lambda t: _compare(t), "a long, b long, score double"))


def _best(pairs: DataFrame) -> DataFrame:
    order = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    return (pairs.groupBy("a", "b").agg(F.max("score").alias("score"))
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= NEIGHBOURS))


def _refine(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """One round: for each vector, compare its neighbours and those whose neighbour it is with one another."""
    around = graph.select(F.col("a").alias("centre"), F.col("b").alias("node")).union(
        graph.select(F.col("b").alias("centre"), F.col("a").alias("node"))).distinct()
    floors = graph.groupBy(F.col("a").alias("node")).agg(
        F.when(F.count("b") == NEIGHBOURS, F.min("score")).otherwise(-2.0).alias("floor"))
    return _grouped(around.join(nodes.select("node", "vec").join(floors, "node"), "node"))


def _linked() -> Callable:
    """Links of the members of two blocks of a component, counting equal vectors each."""

    def run(rows: pa.Table) -> pa.Table:
        x, side = _matrix(rows.column("vec")), rows.column("block").to_numpy()
        copies, nodes = rows.column("copies").to_numpy(), rows.column("node").to_numpy()
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        a, b = np.flatnonzero(side == low), np.flatnonzero(side == high)
        near = x[a] @ x[b].T >= THRESHOLD
        if low == high:
            np.fill_diagonal(near, False)
            return pa.table({"node": nodes[a], "links": near @ copies[b]})
        return pa.table({"node": np.concatenate([nodes[a], nodes[b]]),
                         "links": np.concatenate([near @ copies[b], copies[a] @ near])})

    return run


def _links_in_components(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Number of links of each node: every node against all of its component, in pairs of blocks."""
    sizes = roots.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks"))
    members = roots.join(sizes, "root").join(nodes, "node").withColumn(
        "block", F.pmod(F.hash("node"), F.col("blocks"))).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return (members.select("root", "node", "copies", "vec", "block", F.least("block", "other").alias("low"),
                           F.greatest("block", "other").alias("high"))
            .groupBy("root", "low", "high").applyInArrow(_linked(), "node long, links long")
            .groupBy("node").agg(F.sum("links").alias("links")))


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The angle of each vector with the centre beside it."""
    for batch in batches:
        for part in _by_length(batch):
            cosine = (_matrix(part.column("vec")) * _matrix(part.column("centre"))).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column("root"), pa.array(np.arccos(np.clip(cosine, -1, 1)))], ["root", "angle"])


def _near_balls(rows: pa.Table) -> pa.Table:
    """Pairs of components of two blocks whose balls leave room for a link."""
    x, side = _matrix(rows.column("vec")), rows.column("block").to_numpy()
    radius, root = rows.column("radius").to_numpy(), rows.column("root").to_numpy()
    a, b = (np.flatnonzero(side == rows.column(c)[0].as_py()) for c in ("low", "high"))
    angle = np.arccos(np.clip(x[a] @ x[b].T, -1, 1))
    i, j = np.nonzero((angle <= radius[a][:, None] + radius[b][None, :] + _REACH) & (root[a][:, None] != root[b][None, :]))
    return pa.table({"p": np.minimum(root[a[i]], root[b[j]]), "q": np.maximum(root[a[i]], root[b[j]])})


def _bridges(rows: pa.Table) -> pa.Table:
    """A link for each two components that members of two blocks link."""
    x, side = _matrix(rows.column("vec")), rows.column("block").to_numpy()
    node, root = rows.column("node").to_numpy(), rows.column("root").to_numpy()
    a, b = (np.flatnonzero(side == rows.column(c)[0].as_py()) for c in ("low", "high"))
    i, j = np.nonzero((x[a] @ x[b].T >= THRESHOLD) & (root[a][:, None] != root[b][None, :]))
    i, j = a[i], b[j]
    ends = np.stack([np.minimum(root[i], root[j]), np.maximum(root[i], root[j])], axis=1)
    first = np.unique(ends, axis=0, return_index=True)[1] if len(i) else i
    return pa.table({"a": node[i[first]], "b": node[j[first]]})


def _in_blocks(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links between members of different components in the pairs ``low, high`` of blocks."""
    ends = pairs.select(F.col("low").alias("block"), "low", "high").union(
        pairs.where("low != high").select(F.col("high").alias("block"), "low", "high"))
    return (members.join(ends, "block").groupBy("low", "high", F.size("vec").alias("length"))
            .applyInArrow(lambda t: _bridges(t), "a long, b long"))


def _links_between_components(nodes: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Links between components that may hold saturated lists, a link for each two that have any; none is missed.

    Each component lies in a ball about one member. Balls too far apart for a link are left out, all members of the
    others are compared.
    """
    sizes = checkpointed(roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > NEIGHBOURS))
    count = sizes.count()
    if count < 2:
        return None
    members = roots.join(sizes, "root").join(nodes.select("node", "vec"), "node")
    centres = members.where("node = root").select("root", F.col("vec").alias("centre"))
    radius = (members.select("root", "vec").join(centres, "root").mapInArrow(_angles, "root long, angle double")
              .groupBy("root").agg(F.max("angle").alias("radius")))
    pieces = -(-count // _BLOCK)
    balls = (centres.withColumnRenamed("centre", "vec").join(radius, "root")
             .withColumn("block", F.pmod(F.hash("root"), F.lit(pieces)))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))))
    pairs = checkpointed(
        balls.select("root", "vec", "radius", "block", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high"))
        .groupBy("low", "high", F.size("vec").alias("length")).applyInArrow(lambda t: _near_balls(t), "p long, q long")
        .distinct())
    met = sizes.join(pairs.select(F.col("p").alias("root")).union(pairs.select("q")).distinct(), "root")
    small = met.where(F.col("size") < _WIDE).agg(F.sum("size")).first()[0] or 0
    # Small components share blocks, large ones have several.
    met = met.withColumn("parts", F.when(F.col("size") < _WIDE, 1).otherwise(F.ceil(F.col("size") / _WIDE)).cast("int"))

    def block(part: Column) -> Column:
        return F.when(F.col("size") < _WIDE, F.pmod(F.xxhash64("root"), F.lit(-(-small // _WIDE) or 1))).otherwise(
            F.xxhash64("root", part))

    homes = checkpointed(met.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "root", block(F.col("part")).alias("block")))
    at_p, at_q = (homes.select(F.col("root").alias(c), F.col("block").alias(f"block_{c}")) for c in ("p", "q"))
    blocks = pairs.join(at_p, "p").join(at_q, "q").select(
        F.least("block_p", "block_q").alias("low"), F.greatest("block_p", "block_q").alias("high")).distinct()
    placed = roots.join(met, "root").join(nodes.select("node", "vec"), "node").select(
        "node", "root", "vec", block(F.pmod(F.hash("node"), F.col("parts"))).alias("block"))
    return checkpointed(_in_blocks(placed, blocks))


def _planes(count: int) -> tuple[int, int]:
    """Bits of a cell's name and number of tables. More bits thin out the cells of a linked pair, so there are as many
    tables as it takes it to share one on average."""
    bits = max(1, int(np.ceil(np.log2(max(2, count / CELL)))))
    return bits, max(TABLES, int(np.ceil((1 - np.arccos(THRESHOLD) / np.pi) ** -bits)))


def _by_planes(nodes: DataFrame, count: int, seed: int) -> DataFrame:
    """Pairs of vectors that share a cell of the tables with this seed."""
    bits, tables = _planes(count)
    cells = nodes.mapInArrow(_cells(bits, tables, seed), T.StructType(
        [T.StructField("centre", T.LongType()), T.StructField("node", T.LongType()), nodes.schema["vec"]]))
    return _grouped(cells.withColumn("floor", F.lit(-2.0)))


def audit(nodes: DataFrame, roots: DataFrame) -> float:
    """Share of its own links that a node's component holds, found by comparing sampled nodes with all nodes: the mean
    over the nodes of small components or that over those of large ones, whichever is lower.

    Links may be so rare that no node of a plain sample has any. So half of the sample are nodes that planes of the
    audit's own, which the search has not used, show with a link. Only if neither these planes nor the plain sample
    have any link is there nothing to miss.
    """
    count = nodes.count()
    linked = _by_planes(nodes, count, _AUDIT_SEED).where(F.col("score") >= THRESHOLD)
    linked = checkpointed(linked.select(F.col("a").alias("node")).union(linked.select("b")).distinct()
                          .orderBy(F.xxhash64("node")).limit(AUDITED))
    sizes = roots.groupBy("root").agg((F.count(F.lit(1)) > NEIGHBOURS).alias("large"))
    placed = nodes.join(roots.join(sizes, "root"), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("large", F.lit(False)).alias("large"), "vec")
    chosen = placed.orderBy(F.xxhash64("node")).limit(AUDITED).union(placed.join(linked, "node", "left_semi"))
    sample = chosen.dropDuplicates(["node"]).toArrow()
    large = dict(zip(sample.column("node").to_pylist(), sample.column("large").to_pylist()))
    parts = {p.column("vec").value_lengths()[0].as_py(): (_matrix(p.column("vec")), p.column("node").to_numpy(),
                                                          p.column("root").to_numpy())
             for b in sample.combine_chunks().to_batches() for p in _by_length(b)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        real, found = ({n: np.zeros(len(p[1]), np.int64) for n, p in parts.items()} for _ in range(2))
        for batch in batches:
            for part in _by_length(batch):
                size = part.column("vec").value_lengths()[0].as_py()
                if size in parts:
                    x, names, sides = parts[size]
                    near = (x @ _matrix(part.column("vec")).T >= THRESHOLD) & (names[:, None] != part.column("node").to_numpy())
                    real[size] += near.sum(axis=1)
                    found[size] += (near & (sides[:, None] == part.column("root").to_numpy())).sum(axis=1)
        for size, (_, names, _) in parts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(real[size]), pa.array(found[size])], ["node", "real", "found"])

    # At most twice AUDITED rows.
    counts = (placed.select("node", "root", "vec").mapInArrow(run, "node long, real long, found long")
              .groupBy("node").agg(F.sum("real").alias("real"), F.sum("found").alias("found")).where("real > 0").collect())
    _log.info("audit: %d of %d sampled vectors have links", len(counts), sample.num_rows)
    shares = [[r.found / r.real for r in counts if large[r.node] == kind] for kind in (False, True)]
    return min((sum(s) / len(s) for s in shares if s), default=1.0)


def _links_of_all(nodes: DataFrame, count: int) -> DataFrame:
    """Links that connect all that is linked, from comparing all nodes with each other in blocks."""
    pieces = -(-count // _WIDE)
    members = nodes.select("node", F.col("node").alias("root"), "vec").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.lit(pieces)))
    side = nodes.sparkSession.range(pieces)
    pairs = side.select(F.col("id").alias("low"), F.explode(F.sequence("id", F.lit(pieces - 1).cast("long"))).alias("high"))
    return checkpointed(_in_blocks(members, pairs))


def deduplicate(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each row: id, ``n_links`` (other rows linked with it), ``component_id`` (smallest id that links
    reach) and ``kept`` (whether that is its own).

    Vectors without a direction (NULL, empty, zero, or with a component that is NULL or not finite) link with nothing,
    and so do vectors of different lengths. Rows that repeat a vector are linked with each other, whatever their ids.
    Other columns are ignored; an empty table gives no rows. Every link is a similarity of the threshold or more. The
    search ends when ``audit`` finds the share of links asked for; if it never does, all vectors are compared.
    """
    rows = vectors.select(F.col(id_col), (F.col(vector_col)).alias("vec"), usable(F.col(vector_col)).alias("ok"))
    one = rows.where("ok").groupBy("vec").agg(F.min(id_col).alias("name"), F.count(F.lit(1)).alias("copies"))
    # Nodes are numbered by what they are, so that repeated ids and NULL ids stay apart.
    nodes, _ = stored(one.select(F.xxhash64("vec").alias("node"), "name", "copies", "vec"), "vectors")
    count = nodes.count()
    links, roots, graph = None, None, None
    for turn in range(MOST_ROUNDS):
        # Where the audit isn't content, other planes bring new candidates, and rounds after them follow these up.
        if turn == 0 or turn > ROUNDS and (turn - ROUNDS) % 2:
            fresh = _by_planes(nodes, count, turn)
        else:
            fresh = _refine(graph, nodes)
        fresh = checkpointed(fresh)
        both = fresh if graph is None else graph.select("a", "b", "score").union(fresh)
        graph = checkpointed(_best(both))
        near = fresh.where(F.col("score") >= THRESHOLD).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = near if links is None else links.union(near)
        if turn >= ROUNDS:
            roots = checkpointed(components(links))
            between = _links_between_components(nodes, roots)
            if between is not None and not between.isEmpty():
                links = links.union(between)
                roots = checkpointed(components(links))
            recall = audit(nodes, roots)
            if recall >= RECALL:
                break
    else:
        _log.warning("recall of links is %.4f after %d rounds; comparing all %d vectors", recall, MOST_ROUNDS, count)
        roots = checkpointed(components(_links_of_all(nodes, count)))
    counted = _links_in_components(nodes, roots)
    least = roots.join(nodes.select("node", "name"), "node").groupBy("root").agg(F.min("name").alias("least"))
    known = (nodes.join(counted, "node", "left").join(roots, "node", "left").join(least, "root", "left")
             .select("vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("least", "name").alias("component_id")))
    placed = rows.where("ok").join(known, "vec").select(id_col, "n_links", "component_id").unionByName(
        rows.where("not ok").select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id")))
    return placed.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
