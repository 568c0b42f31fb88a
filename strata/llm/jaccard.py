"""Jaccard join of whole texts on word shingles: adaptive prefixes with several required matches.

All shingles are put into one order, rare ones first. Two sets that are similar enough share tokens among the first of
each: a set of ``n`` shows its first ``n - ceil(0.75 n) + l`` tokens, and pairs must share ``l`` of them. Each text
chooses its own ``l`` by the estimated cost of its candidates, and the sizes of a pair can ask for many more matches.

Texts with equal sets are one node from the beginning. Groups of near copies aren't expanded into pairs: first, each
node is checked against the most central node that it shares smallest hashes with; after that only pairs whose ends
these links leave apart are counted and checked. Where very many nodes show a token, their pairs aren't even counted:
they are a family, and its sets are compared in blocks. So every link between nodes is found or implied by others.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from strata.cluster import checkpointed
from strata.llm.components import components
from strata.llm.storage import drop, stored
from strata.llm.textblocks import blocks, distinct_per_text, mix, release, shingles_of, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
# Similarity: 100 * intersection >= PERCENT * union.
PERCENT = 75
# Largest number of required matches that a text chooses.
MOST_MATCHES = 4
# The order of shingles comes from counts of all shingles in a table of fixed size; any order gives right results.
COUNTERS = 1 << 20
_CHUNKS = 64
# Nodes of a token that makes more pairs than this are a family, whose whole sets are compared in blocks of nodes.
_PAIRS_OF_TOKEN, _BLOCK = 4096, 256
_TOKENS_AT_ONCE = 1 << 13
# Tokens counted so often, and well above the mean counter, never meet in one shard: their nodes are a family at once.
_HOT = 1 << 17
_FEW = 12
# Parts of the range of hashes: the smallest hash in each is a key by which central nodes are found.
_PARTS = 8
_MEMBERS = 1 << 23
_NODE = ["node", "n", "rest", "matches", "central"]


def _sets(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a block's texts (sorted by text), where each text begins, and each text's size and key."""
    n = part.num_rows
    hashes, docs, _ = shingles_of(words_of(part.column("text")), n, WORDS)
    hashes, docs, _ = distinct_per_text(hashes, docs)
    cuts = np.searchsorted(docs, np.arange(n + 1))
    running = np.zeros((2, len(hashes) + 1), np.uint64)
    np.cumsum(hashes, out=running[0, 1:])
    np.cumsum(mix(hashes + np.uint64(1)), out=running[1, 1:])
    sums = running[:, cuts[1:]] - running[:, cuts[:-1]]
    keys = mix(mix(sums[0]) + sums[1] + np.diff(cuts).astype(np.uint64)).view(np.int64)
    return hashes, cuts, np.diff(cuts), keys


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle counts of a task by hash, in chunks."""
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for part in blocks(batch, "text"):
            hashes = _sets(part)[0]
            counts += np.bincount((hashes % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    if counts.any():
        salt = int(counts[:1024].sum() % 1_000_003)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_CHUNKS), pa.int32()), pa.array([salt] * _CHUNKS, pa.int32()),
             pa.array([_pack(c) for c in counts.reshape(_CHUNKS, -1)], pa.binary())], ["chunk", "salt", "counts"])


def _add_up(rows: pa.Table) -> pa.Table:
    total = sum(_unpack(c, "<i8") for c in rows.column("counts").to_pylist())
    return pa.table({"chunk": rows.column("chunk")[:1], "salt": pa.array([0], pa.int32()),
                     "counts": pa.array([_pack(total)], pa.binary())})


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """How often the shingles of each hash remainder occur in all texts: a table of fixed size."""
    schema, spread = "chunk int, salt int, counts binary", int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.mapInArrow(_count, schema).withColumn("salt", F.col("salt") % spread)
    rows = rows.groupBy("chunk", "salt").applyInArrow(lambda t: _add_up(t), schema)
    rows = rows.groupBy("chunk").applyInArrow(lambda t: _add_up(t), schema)
    out = np.zeros((_CHUNKS, COUNTERS // _CHUNKS), np.int64)
    for r in rows.collect():
        out[r.chunk] = _unpack(bytes(r.counts), "<i8")
    release()
    return out.ravel()


class _Shown:
    """Nodes of a block with the tokens that they show, and what else is needed of them."""

    def __init__(self, counts: np.ndarray, part: pa.RecordBatch) -> None:
        hashes, _, sizes, keys = _sets(part)
        _, first = np.unique(keys, return_index=True)
        rows = np.sort(first[sizes[first] > 0])
        docs = np.repeat(np.arange(len(sizes)), sizes)
        chosen = np.zeros(len(sizes), bool)
        chosen[rows] = True
        hashes, docs = hashes[chosen[docs]], docs[chosen[docs]]
        self.nodes, self.n = keys[rows], sizes[rows]
        self.sorted, self.begin = hashes, np.cumsum(self.n) - self.n
        common = counts[(hashes % np.uint64(COUNTERS)).astype(np.int64)]
        order = np.lexsort((hashes, common, docs))
        hashes, common = hashes[order], common[order]
        # Rare tokens cost one look, common ones as many as they have beyond what chance puts on a counter.
        looks = np.concatenate([[0.0], np.cumsum(np.maximum(1.0, common - max(1.0, float(counts.mean()))))])
        least = -(-PERCENT * self.n // 100)
        best, self.matches = np.full(len(rows), np.inf), np.ones(len(rows), np.int64)
        for l in range(1, MOST_MATCHES + 1):
            end = self.begin + np.minimum(self.n - least + l, self.n)
            cost = (looks[end] - looks[self.begin]) * (1 + 4 / l)
            better = (l <= least) & (cost < best)
            best[better], self.matches[better] = cost[better], l
        self.shown = self.n - least + self.matches
        rank = np.arange(len(hashes)) - np.repeat(self.begin, self.n)
        self.tokens = hashes[rank < np.repeat(self.shown, self.n)]
        self.central = np.add.reduceat(np.log2(common + 1.0), self.begin) / self.n if len(rows) else np.zeros(0)

    def smallest(self) -> np.ndarray:
        """Smallest hash of each node in each part of the range; -1 where it has none there."""
        owner = np.repeat(np.arange(len(self.n)), self.n)
        part = (self.sorted >> np.uint64(61)).astype(np.int64)
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])
        out = np.full((len(self.n), _PARTS), -1, np.int64)
        out[owner[new], part[new]] = self.sorted[new].view(np.int64)
        return out


def _nodes(packed: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _unpack(packed, "<i8")
        for batch in batches:
            for part in blocks(batch, "text"):
                x = _Shown(counts, part)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(x.smallest().ravel()), _PARTS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.nodes), pa.array(x.n, pa.int32()), pa.array(x.n - x.shown, pa.int32()),
                     pa.array(x.matches, pa.int32()), pa.array(x.central), keys], [*_NODE, "keys"])

    return run


def _tokens(packed: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _unpack(packed, "<i8")
        for batch in batches:
            for part in blocks(batch, "text"):
                x = _Shown(counts, part)
                cuts = np.concatenate([[0], np.cumsum(x.shown)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.nodes), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x.tokens.view(np.int64)))],
                    ["node", "tokens"])

    return run


def _hot_counters(counts: np.ndarray) -> np.ndarray:
    return np.flatnonzero(counts > _HOT + 4 * counts.mean()).astype(np.uint64)


def _hot(counters: np.ndarray) -> Callable:
    """A row for each node and hot token that it shows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("tokens")
            tokens = column.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            at = np.isin(tokens.view(np.uint64) % np.uint64(COUNTERS), counters)
            node, label = (batch.column(c).to_numpy()[owner[at]] for c in ("node", "label"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[at]), pa.array(node), pa.array(np.where(label == 0, node, label)),
                 pa.array(batch.column("central").to_numpy()[owner[at]])], ["token", "node", "label", "central"])

    return run


def _dealt(shards: int, hot: np.ndarray) -> Callable:
    """Blobs by shard of the tokens that nodes show, with the nodes and, where links gave them one, their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("tokens")
            tokens = column.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            if len(hot):
                cool = ~np.isin(tokens % np.uint64(COUNTERS), hot)
                tokens, owner = tokens[cool], owner[cool]
            nodes, labels = (batch.column(c).to_numpy() for c in ("node", "label"))
            central = batch.column("central").to_numpy().astype(np.float32)
            shard = (tokens >> np.uint64(40)).astype(np.int64) % shards
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = []
            for s in np.flatnonzero(cuts[1:] > cuts[:-1]):
                own = order[cuts[s]:cuts[s + 1]]
                who, times = np.unique(owner[own], return_counts=True)
                rows.append((int(s), _pack(tokens[own]), _pack(times.astype("<i4")), _pack(nodes[who]),
                             _pack(labels[who]), _pack(central[who])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 6)]],
                ["shard", "tokens", "times", "nodes", "labels", "central"])

    return run


def _candidates(rows: pa.Table) -> pa.Table:
    """Pairs of nodes with different labels that show the same tokens of a shard, and how many; and for tokens that too
    many of them show, the nodes and labels under the most central node's name."""
    def read(name: str, kind: str) -> list[np.ndarray]:
        return [_unpack(x, kind) for x in rows.column(name).to_pylist()]

    times = np.concatenate(read("times", "<i4"))
    tokens = np.concatenate(read("tokens", "<u8"))
    node, label = (np.repeat(np.concatenate(read(c, "<i8")), times) for c in ("nodes", "labels"))
    label = np.where(label == 0, node, label)
    central = np.repeat(np.concatenate(read("central", "<f4")), times)
    order = np.lexsort((node, label, tokens))
    tokens, node, label, central = tokens[order], node[order], label[order], central[order]
    new = np.ones(len(tokens) + 1, bool)
    new[1:-1] = tokens[1:] != tokens[:-1]
    cuts = np.flatnonzero(new)
    size = np.diff(cuts)
    several = label[cuts[:-1]] != label[cuts[1:] - 1]
    few = np.repeat(size <= _FEW, size)
    x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, _FEW):  # short lists all at once
        at = np.flatnonzero(few[:-step] & (tokens[:-step] == tokens[step:]) & (label[:-step] != label[step:]))
        x.append(node[at])
        y.append(node[at + step])
    families: dict[int, list[np.ndarray]] = {}
    for a, b in zip(cuts[:-1][several & (size > _FEW)], cuts[1:][several & (size > _FEW)]):
        names, counts = np.unique(label[a:b], return_counts=True)
        major = names[counts.argmax()]
        minor = np.flatnonzero(label[a:b] != major) + a
        if len(minor) * (b - a) > _PAIRS_OF_TOKEN:
            top = a + np.lexsort((node[a:b], central[a:b]))[-1]
            families.setdefault(int(node[top]), []).append(np.arange(a, b))
            continue
        for m in minor:  # each pair once: with the major ones, and with minor ones behind it
            other = np.flatnonzero((label[a:b] != label[m]) & ((label[a:b] == major) | (node[a:b] > node[m]))) + a
            x.append(np.full(len(other), node[m]))
            y.append(node[other])
    x, y = np.concatenate(x), np.concatenate(y)
    x, y = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    at = np.flatnonzero(new)
    release()
    members = [(top, np.unique(np.stack([node[m], label[m]], axis=1), axis=0)) for top, m in
               ((top, np.concatenate(lists)) for top, lists in families.items())]
    none = [None] * len(members)
    return pa.table({
        "a": pa.array(x[at].tolist() + none, pa.int64()), "b": pa.array(y[at].tolist() + none, pa.int64()),
        "shared": pa.array(np.diff(np.append(at, len(x))).tolist() + none, pa.int64()),
        "family": pa.array([None] * len(at) + [t for t, _ in members], pa.int64()),
        "members": pa.array([None] * len(at) + [_pack(m) for _, m in members], pa.binary())})


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each node of the families that a shard found."""
    for batch in batches:
        for family, members in zip(batch.column("family").to_pylist(), batch.column("members").to_pylist()):
            both = _unpack(members, "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(both), family)), pa.array(both[:, 0]), pa.array(both[:, 1])], ["family", "node", "label"])


def _in_blocks(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members ``family, node, label`` with their blocks, and the pairs of blocks that hold different labels.

    Labels with many nodes have blocks of their own, those with few share blocks.
    """
    sizes = members.groupBy("family", "label").agg(F.count(F.lit(1)).alias("size"))
    packs = sizes.where(F.col("size") < _BLOCK).groupBy("family").agg(F.ceil(F.sum("size") / _BLOCK).alias("packs"))
    sizes = checkpointed(sizes.join(packs, "family", "left").withColumn(
        "parts", F.when(F.col("size") < _BLOCK, 1).otherwise(F.ceil(F.col("size") / _BLOCK)).cast("int")))

    def block(part: Column) -> Column:
        return F.when(F.col("size") < _BLOCK, F.pmod(F.xxhash64("label"), F.col("packs"))).otherwise(F.xxhash64("label", part))

    homes = checkpointed(sizes.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
                         .select("family", block(F.col("part")).alias("block"), "label")
                         .groupBy("family", "block").agg(F.min("label").alias("first"), F.max("label").alias("last")))
    low, high = (homes.select("family", *[F.col(c).alias(f"{side}_{c}") for c in ("block", "first", "last")])
                 for side in ("low", "high"))
    pairs = low.join(high, "family").where("low_block <= high_block").where(  # one label: these links are known
        "least(low_first, high_first) != greatest(low_last, high_last)").select(
        "family", F.col("low_block").alias("low"), F.col("high_block").alias("high"))
    placed = members.join(sizes, ["family", "label"]).select(
        "family", "node", "label", block(F.pmod(F.hash("node"), F.col("parts"))).alias("block"))
    return placed, pairs


def _compare_blocks(rows: pa.Table) -> pa.Table:
    """Links between nodes of two blocks with different labels, as many as connect what they connect."""
    side, node, label = (rows.column(c).to_numpy() for c in ("side", "node", "label"))
    lists = rows.column("tokens").combine_chunks()
    n = lists.value_lengths().to_numpy().astype(np.int64)
    _, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    owner = np.repeat(np.arange(len(node)), n)
    often = np.bincount(code)
    keep = often[code] > 1
    number = np.cumsum(often > 1) - 1
    code, owner = number[code[keep]], owner[keep]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1) if (side == 1).any() else first
    shared = np.zeros((len(first), len(second)), np.float32)
    for begin in range(0, int(code[-1]) + 1 if len(code) else 0, _TOKENS_AT_ONCE):
        a, b = np.searchsorted(code, [begin, begin + _TOKENS_AT_ONCE])
        matrix = np.zeros((len(node), _TOKENS_AT_ONCE), np.float32)
        matrix[owner[a:b], code[a:b] - begin] = 1
        shared += matrix[first] @ matrix[second].T
    union = n[first][:, None] + n[second][None, :] - shared
    x, y = np.nonzero((100 * shared >= PERCENT * union) & (label[first][:, None] != label[second][None, :]))
    parent = {int(v): int(v) for v in np.unique(label)}
    out = []
    for i, j in zip(first[x], second[y]):
        a, b = int(label[i]), int(label[j])
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((node[i], node[j]))
    return pa.table({"a": np.array([o[0] for o in out], np.int64), "b": np.array([o[1] for o in out], np.int64)})


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null and text != ''")


def _sizes(keyed: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                _, _, sizes, keys = _sets(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column(keyed), pa.array(sizes, pa.int64()), pa.array(keys, mask=sizes == 0)],
                    [keyed, "n_shingles", "node"])

    return run


def _chosen_sets(members: np.ndarray) -> Callable:
    """Sets of the nodes that may be members (a bitmap by their lowest bits), once in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                hashes, cuts, sizes, keys = _sets(part)
                at = keys & (_MEMBERS - 1)
                wanted = np.flatnonzero((members[at >> 3] >> (at & 7).astype(np.uint8)) & 1 & (sizes > 0))
                _, first = np.unique(keys[wanted], return_index=True)
                wanted = np.sort(wanted[first])
                if len(wanted):
                    n = sizes[wanted]
                    flat = hashes[np.repeat(cuts[wanted] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[wanted]), pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat.view(np.int64)))],
                        ["node", "tokens"])

    return run


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """Bits of fixed number with those of all nodes set, put together in tasks."""

    out = np.zeros(_MEMBERS // 8, np.uint8)
    size = 1 << 15
    at = nodes.select(F.pmod("node", F.lit(_MEMBERS)).alias("at"))
    for r in at.groupBy(F.floor(F.col("at") / size).alias("part")).agg(
            F.bitmap_construct_agg(F.col("at") % size).alias("bits")).collect():
        out[r.part * size // 8:(r.part + 1) * size // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _sets_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The whole sets of the nodes that are asked for; only these are shuffled."""
    wanted = checkpointed(wanted.select("node").distinct())
    sets = texts.mapInArrow(_chosen_sets(_bitmap(wanted)), "node long, tokens array<long>")
    return sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose whole sets are similar enough."""
    pairs = checkpointed(pairs)
    sets = _sets_of(texts, pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))))
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b"))
    inside = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - inside
    return checkpointed(both.where(100 * inside >= PERCENT * union).select("a", "b"))


def _within_families(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Links inside families, found by comparing the blocks of nodes that hold different labels."""
    placed, pairs = _in_blocks(checkpointed(members.distinct()))
    pairs = checkpointed(pairs)
    ends = pairs.select("family", F.col("low").alias("block"), "low", "high", F.lit(0).alias("side")).union(
        pairs.where("low != high").select("family", F.col("high").alias("block"), "low", "high", F.lit(1).alias("side")))
    met = checkpointed(placed.join(ends.select("family", "block").distinct(), ["family", "block"], "left_semi"))
    return checkpointed(met.join(_sets_of(texts, met), "node").join(ends, ["family", "block"])
                        .groupBy("family", "low", "high").applyInArrow(lambda t: _compare_blocks(t), "a long, b long"))


def _needed(n_a: Column, n_b: Column, rest_a: Column, rest_b: Column, l_a: Column, l_b: Column) -> Column:
    """Shown tokens that a similar pair shares at least: all its common tokens but those behind the shown ones."""
    common = F.ceil(F.lit(PERCENT) * (n_a + n_b) / (100 + PERCENT))
    return F.greatest(F.least(l_a, l_b).cast("long"), common - F.greatest(rest_a, rest_b))


def _central(nodes: DataFrame) -> DataFrame:
    """Each node with the central node that it shares most smallest hashes with, two at least or all it has."""
    keyed = nodes.select("node", "n", "central", F.explode(F.array_distinct("keys")).alias("key")).where("key != -1")
    first = keyed.groupBy("key").agg(F.max(F.struct("central", "node")).alias("first"), F.count(F.lit(1)).alias("size"))
    first = first.where("size > 1").select("key", F.col("first.node").alias("b"))
    shared = keyed.join(first, "key").where("node != b").groupBy(F.col("node").alias("a"), "b").agg(
        F.count(F.lit(1)).alias("shared"), F.first("n").alias("n")).where("shared >= least(2, n)")
    return shared.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))


def links_between(texts: DataFrame) -> DataFrame:
    """Links ``a, b`` between the sets of the texts (column ``text``); implied links may be missing."""
    spark = texts.sparkSession
    shards = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = shingle_counts(texts)
    packed = _pack(counts)  # goes to tasks with each function
    nodes = texts.mapInArrow(_nodes(packed), (
        "node long, n int, rest int, matches int, central double, keys array<long>"))
    nodes, path = stored(nodes.groupBy("node").agg(*[F.first(c).alias(c) for c in (*_NODE[1:], "keys")]), "nodes")
    links = _verified(texts, _central(nodes))
    labels = checkpointed(components(links)).withColumnRenamed("root", "label")
    tokens = texts.mapInArrow(_tokens(packed), "node long, tokens array<long>")
    tokens = (tokens.groupBy("node").agg(F.first("tokens").alias("tokens")).join(nodes.select("node", "central"), "node")
              .join(labels, "node", "left").select("node", "tokens", "central", F.coalesce("label", F.lit(0)).alias("label")))
    hot = _hot_counters(counts)
    found = checkpointed(
        tokens.mapInArrow(_dealt(shards, hot), "shard int, tokens binary, times binary, nodes binary, labels binary, central binary")
        .groupBy("shard").applyInArrow(lambda t: _candidates(t), "a long, b long, shared long, family long, members binary"))
    pairs = found.where("family is null").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    size = nodes.select("node", "n", "rest", "matches")
    for end in ("a", "b"):
        pairs = pairs.join(size.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("n", "rest", "matches")]), end)
    pairs = pairs.where(
        (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")) & (F.col("shared") >= _needed(
            F.col("n_a"), F.col("n_b"), F.col("rest_a"), F.col("rest_b"), F.col("matches_a"), F.col("matches_b"))))
    links = links.union(_verified(texts, pairs.select("a", "b")))
    members = found.where("family is not null").select("family", "members").mapInArrow(
        _members, "family long, node long, label long")
    if len(hot):
        shown = checkpointed(tokens.mapInArrow(_hot(hot), "token long, node long, label long, central double"))
        first = shown.groupBy("token").agg(F.max_by("node", F.struct("central", "node")).alias("family"),
                                           F.count(F.lit(1)).alias("size")).where("size > 1")
        members = members.union(shown.join(first, "token").select("family", "node", "label"))
    links = links.union(_within_families(texts, members))
    drop(spark, path)
    return links


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``node`` (of equal sets).

    ``component_id`` is the smallest id reachable by links, its own included. Words are runs of bytes that are not white
    space, A-Z in lower case. A text with fewer than five words is one shingle as a whole; a text without words or a
    NULL text has an empty set, no node and no links. Rows with a repeated id are nodes of their own texts; a NULL id is
    the smallest of a component only where it has no other. Other columns are ignored; an empty table gives no rows.
    """
    keyed = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = keyed.schema[id_col].dataType.simpleString()
    sized = checkpointed(keyed.mapInArrow(_sizes(id_col), f"`{id_col}` {kind}, n_shingles long, node long"))
    roots = components(links_between(_texts(docs, text_col)))
    placed = checkpointed(sized.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = placed.where("root is not null").groupBy("root").agg(F.min(id_col).alias("component_id"))
    return placed.join(least, "root", "left").select(
        id_col, "n_shingles", F.coalesce("component_id", F.col(id_col)).alias("component_id"), "node")
