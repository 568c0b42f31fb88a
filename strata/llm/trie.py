"""Prefix trie of conversations that share heads, without writing any rebuilt conversation.

A conversation is rebuilt as the first ``h`` turns of its base conversation and then its own turns after the first
``h``. A run of turns has a fingerprint in a monoid: the pair (length n, sum s of v_i * B**i over its turns), with
(n1, s1) * (n2, s2) = (n1 + n2, s1 + B**n1 * s2). Running sums give it for the first turns of every conversation as it
stands; that of a rebuilt prefix is the product of the base's head and of the own turns after the first ``h``, which is
a quotient of two running sums. So each (conversation, depth) gets a row of numbers, and prefixes group by fingerprint.
Sums are taken modulo the prime 2**31 - 1 with four bases.

Turns are stored once as references: 240 bits of the SHA-256 of role and text, and the length. A group of equal fingerprints is a node only
if all its members refer to equal last turns and to equal parents, which by induction makes their prefixes equal; a
collision ends the job.

A conversation that is the smallest member of a node is the smallest of one child of it too, unless it ends there. So
each conversation stands for one chain of nodes down to its end, and what a subtree sums up is what the chains of its
members sum up: chains are totalled once, and no level is visited after another.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.storage import drop, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIME = (1 << 31) - 1
_BASES = (1103515245, 630360016, 1664525, 742938285)
_LANES = range(len(_BASES))
# Turns of a conversation, and depths of a chain, are summed in runs of so many values of their order, then run by run.
RUN = 4096
# Ids that end at a node are joined to text in ranges of so many.
ENDS_AT_ONCE = 1024
_REF = [f"r{k}" for k in range(4)]
_TERM, _SUM, _FINGER, _PARENT = ([f"{c}{k}" for k in _LANES] for c in "tsfp")
_KEY = ["depth", *_FINGER]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


class Heads(NamedTuple):
    """How conversations are rebuilt: the base of each, and how many turns its head has at most ``most``."""

    base: Column
    size: Column
    most: int


def standard_heads(conv_col: str = "conv_id") -> Heads:
    """Base ``c - c % 5``, and ``crc32(c) % 9`` turns."""
    c = F.col(conv_col)
    return Heads(c - c % 5, (F.crc32(c.cast("string")) % 9).cast("long"), 8)


def _power(base: int, n: Column) -> Column:
    """``base ** n`` modulo the prime for 0 <= n < 2**32: a power is looked up for each half byte of ``n``."""
    out = None
    for digit in range(8):
        powers = ",".join(f"{pow(base, k << 4 * digit, PRIME)}L" for k in range(16))
        factor = F.get(F.expr(f"array({powers})"), F.shiftrightunsigned(n, 4 * digit).bitwiseAND(15).cast("int"))
        out = factor if out is None else out * factor % PRIME
    return out


def _small_power(base: int, first: int, last: int, n: Column) -> Column:
    """The same for ``first <= n <= last``, below zero too."""
    table = F.array(*[F.lit(pow(base, k, PRIME)).cast("long") for k in range(first, last + 1)])
    return F.get(table, (n - first).cast("int"))


def _running(keys: list[str], *order: Column) -> tuple[Window, Window]:
    """Windows over a group up to each row, and before it."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(Window.unboundedPreceding, -1)


def turn_references(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, place, r0.., n_bytes, t0.., s0..``: each turn's place (from 1), its reference, the bytes of its
    text, what it adds to the running sums, and the sums up to it.

    Turns go by ``turn`` (NULL first), then role, then reference. Only references are shuffled, no texts. A conversation
    is cut into runs of ``RUN`` turn numbers that are summed apart; runs are then put together as products.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    # The length of the role in front keeps (role, text) apart from any other split of the same characters.
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.sha2(whole.cast("binary"), 256).alias("ref"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = rows.select("conv_id", "turn", "role", "n_bytes", F.floor(F.col("turn") / RUN).alias("run"), *[
        F.conv(F.substring("ref", 15 * k + 1, 15), 16, 10).cast("long").alias(r) for k, r in enumerate(_REF)])
    order = [F.col("turn").asc_nulls_first(), F.col("role"), *map(F.col, _REF)]
    run, _ = _running(["conv_id", "run"], *order)
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "run").orderBy(*order)).cast("long"))
    rows = rows.withColumns({t: (F.pmod(F.xxhash64(F.lit(k), *_REF), F.lit(PRIME - 1)) + 1)
                             * _power(_BASES[k], F.col("place")) % PRIME for k, t in enumerate(_TERM)})
    rows = rows.withColumns({s: F.sum(t).over(run) % PRIME for s, t in zip(_SUM, _TERM)})
    # What stands before each run: only conversations with several runs have any.
    totals = rows.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n"), *[
        (F.sum(t) % PRIME).alias(f"w{k}") for k, t in enumerate(_TERM)])
    _, before = _running(["conv_id"], F.col("run").asc_nulls_first())
    carried = totals.withColumn("c", F.sum("n").over(before)).withColumns({
        f"c{k}": F.sum(_power(_BASES[k], F.coalesce("c", F.lit(0))) * F.col(f"w{k}") % PRIME).over(before) % PRIME
        for k in _LANES}).where("c is not null").select(
            F.col("conv_id").alias("_conv"), F.col("run").alias("_run"), "c", *[f"c{k}" for k in _LANES])
    out = rows.join(carried, (F.col("conv_id") == F.col("_conv")) & F.col("run").eqNullSafe(F.col("_run")), "left")
    shift = [F.when(F.col("c").isNull(), 1).otherwise(_power(_BASES[k], F.col("c"))) for k in _LANES]
    return out.select(
        "conv_id", (F.col("place") + F.coalesce("c", F.lit(0))).alias("place"), *_REF, "n_bytes",
        *[(shift[k] * F.col(t) % PRIME).alias(t) for k, t in enumerate(_TERM)],
        *[((F.coalesce(f"c{k}", F.lit(0)) + shift[k] * F.col(s)) % PRIME).alias(s) for k, s in enumerate(_SUM)])


def _heads_of(turns: DataFrame, heads: Heads) -> DataFrame:
    """Per conversation: the turns of its head (``head``, ``k`` of them), the ``h`` asked for, the rebuilt length, the own
    sums up to ``h`` (``o0..``) and the sums of the head (``b0..``)."""
    own = turns.withColumn("h", heads.size).groupBy("conv_id").agg(
        F.first("h").alias("h"), F.max("place").alias("n_own"), *[
            F.coalesce(F.max(F.when(F.col("place") == F.col("h"), F.col(s))), F.lit(0)).alias(f"o{k}")
            for k, s in enumerate(_SUM)]).withColumn("base", heads.base)
    # At most a head's turns of each base, so the lists are bounded.
    bases = turns.where(F.col("place") <= heads.most).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", *_REF, "n_bytes", *_TERM, *_SUM))).alias("turns"))
    joined = own.join(bases, "base", "left").withColumn("head", F.coalesce(
        F.slice("turns", F.lit(1), F.col("h").cast("int")), F.expr("filter(array(named_struct(" + ",".join(
            f"'{c}', bigint(0)" for c in ("place", *_REF, "n_bytes", *_TERM, *_SUM)) + ")), x -> false)")))
    joined = joined.withColumn("k", F.size("head").cast("long"))
    last = F.get("head", (F.col("k") - 1).cast("int"))
    return joined.select(
        "conv_id", "h", "k", "head", (F.col("k") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length"),
        *[f"o{k}" for k in _LANES], *[F.coalesce(last[s], F.lit(0)).alias(f"b{k}") for k, s in enumerate(_SUM)])


def rebuilt_prefixes(turns: DataFrame, heads: Heads) -> DataFrame:
    """Rows ``conv_id, depth, length, r0.., n_bytes, f0.., p0..`` for each conversation and depth, 0 included: last turn
    and fingerprint of its first ``depth`` rebuilt turns, and the fingerprint of the parent."""
    convs = _heads_of(turns, heads)
    root = F.expr("array(named_struct(" + ",".join(
        f"'{c}', bigint(0)" for c in ("place", *_REF, "n_bytes", *_TERM, *_SUM)) + "))")
    tops = convs.select("conv_id", "length", F.explode(F.concat(root, "head")).alias("t")).select(
        "conv_id", F.col("t.place").alias("depth"), "length", *[f"t.{r}" for r in _REF], "t.n_bytes",
        *[F.col(f"t.{s}").alias(f) for f, s in zip(_FINGER, _SUM)],
        *[F.pmod(F.col(f"t.{s}") - F.col(f"t.{t}"), F.lit(PRIME)).alias(p) for p, s, t in zip(_PARENT, _SUM, _TERM)])
    # Own turns keep their places unless the base is shorter than the head asked for.
    rest = turns.join(convs.drop("head"), "conv_id").where("place > h")
    shift = [_small_power(_BASES[k], -heads.most, 0, F.col("k") - F.col("h")) for k in _LANES]
    rest = rest.withColumns({f: (F.col(f"b{k}") + shift[k] * F.pmod(F.col(s) - F.col(f"o{k}"), F.lit(PRIME))) % PRIME
                             for k, (f, s) in enumerate(zip(_FINGER, _SUM))})
    rest = rest.select(
        "conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "length", *_REF, "n_bytes", *_FINGER,
        *[F.pmod(F.col(f) - shift[k] * F.col(t) % PRIME, F.lit(PRIME)).alias(p)
          for k, (p, f, t) in enumerate(zip(_PARENT, _FINGER, _TERM))])
    return tops.unionByName(rest)


def nodes_of(prefixes: DataFrame) -> DataFrame:
    """One row per node: key, ``conv_id``, ``n_convs``, ``childless``, ``n_bytes`` and the parent's fingerprint. A group
    whose members differ in their last turn or in their parent raises."""
    alike = [*_REF, "n_bytes", *_PARENT]
    groups = prefixes.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("deepest"),
        *[F.min(c).alias(c) for c in alike], *[F.max(c).alias(f"_{c}") for c in alike])
    same = F.forall(F.array(*[F.col(c) == F.col(f"_{c}") for c in alike]), lambda x: x)
    return groups.select(
        *_KEY, "conv_id", "n_convs", (F.col("deepest") == F.col("depth")).alias("childless"), F.when(same, F.col("n_bytes"))
        .otherwise(F.raise_error(F.lit("two different prefixes have one fingerprint")).cast("long")).alias("n_bytes"), *_PARENT)


def chain_sums(nodes: DataFrame) -> DataFrame:
    """All nodes plus ``leaves`` and ``saved``: sums over their own chain from their depth on."""
    worth = {"leaves": F.col("childless").cast("long"), "saved": (F.col("n_convs") - 1) * F.col("n_bytes")}
    nodes = nodes.withColumns({**{f"_{c}": v for c, v in worth.items()}, "run": F.floor(F.col("depth") / RUN)})
    inside, _ = _running(["conv_id", "run"], F.desc("depth"))
    _, deeper = _running(["conv_id"], F.desc("run"))
    totals = nodes.groupBy("conv_id", "run").agg(*[F.sum(f"_{c}").alias(c) for c in worth])
    carried = totals.select(F.col("conv_id").alias("_conv"), F.col("run").alias("_run"),
                            *[F.sum(c).over(deeper).alias(f"c_{c}") for c in worth]).where("c_leaves is not null")
    out = (nodes.withColumns({c: F.sum(f"_{c}").over(inside) for c in worth})
           .join(carried, (F.col("conv_id") == F.col("_conv")) & (F.col("run") == F.col("_run")), "left"))
    return out.select(*_KEY, "conv_id", "n_convs", *_PARENT,
                      *[(F.col(c) + F.coalesce(f"c_{c}", F.lit(0))).alias(c) for c in worth])


def _digest_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (conv_id, depth, ids) in order one digest per node. Only a batch of ranges is held at a time."""
    node, state, names = None, None, ["conv_id", "depth", "ends_sha256"]

    def table(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in done], pa.int64()), pa.array(
            [k[1] for k, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], names)

    for batch in batches:
        done = []
        for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node:
                done.append((node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        yield table(done)
    if node:
        yield table([(node, state.hexdigest())])


def _ends(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows ``conv_id, depth, ends_sha256`` for each node at which conversations end.

    Ids become text in ranges of them, and the ranges of a node are digested in order as a stream: SHA-256 can't be put
    together from parts.
    """
    part = F.floor(F.col("conv_id") / ENDS_AT_ONCE)
    ranges = prefixes.where("depth = length").groupBy(*_KEY, part.alias("part")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return (ranges.join(nodes.select(*_KEY, "conv_id"), _KEY).repartition("conv_id", "depth")
            .sortWithinPartitions("conv_id", "depth", "part").select("conv_id", "depth", "ids")
            .mapInArrow(_digest_ranges, "conv_id long, depth long, ends_sha256 string"))


def trie(conversations: DataFrame, heads: Heads | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member) and ``depth`` name a node; ``parent_conv_id`` with ``depth - 1`` names its parent (NULL
    at the root). ``n_convs`` members, ``n_children`` children, ``n_leaves`` childless nodes in the subtree with the node
    itself, ``saved_tokens`` the sum over the subtree of (n_convs - 1) times the UTF-8 bytes of a node's last text, and
    ``ends_sha256``, the digest of the ids of members that end at the node, ascending, with commas between.

    NULL role and text are empty; a NULL turn comes first; equal turns go by role and reference; repeated rows are turns
    of their own. Rows with a NULL conversation belong to none and are left out. A conversation whose head and rest are
    both empty is a member of the root alone. An empty table has no nodes, not even a root. Other columns are ignored.
    """
    heads = heads or standard_heads()
    spark = conversations.sparkSession
    turns, turns_path = stored(turn_references(conversations), "turn-references")
    prefixes, prefixes_path = stored(rebuilt_prefixes(turns, heads), "prefixes")
    nodes, nodes_path = stored(chain_sums(nodes_of(prefixes)), "trie-nodes")
    # A chain's total, given to every node that its conversation is a member of.
    chains = nodes.groupBy("conv_id").agg(F.max("leaves").alias("chain_leaves"), F.max("saved").alias("chain_saved"))
    below = (prefixes.select("conv_id", *_KEY).join(chains, "conv_id").groupBy(*_KEY)
             .agg(F.sum("chain_leaves").alias("all_leaves"), F.sum("chain_saved").alias("all_saved")))
    parent = [(F.col("depth") - 1).alias("depth"), *[F.col(p).alias(f) for p, f in zip(_PARENT, _FINGER)]]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("depth").alias("_depth"), *[F.col(f).alias(f"_{f}") for f in _FINGER],
                         F.col("conv_id").alias("parent_conv_id"))
    up = [F.col("depth") - 1 == F.col("_depth"), *[F.col(p) == F.col(f"_{f}") for p, f in zip(_PARENT, _FINGER)]]
    out = (nodes.join(above, up, "left").join(below, _KEY).join(children, _KEY, "left").join(chains, "conv_id")
           .join(_ends(prefixes, nodes), ["conv_id", "depth"], "left"))
    out, _ = stored(out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        (F.col("all_leaves") - F.col("chain_leaves") + F.col("leaves")).alias("n_leaves"),
        (F.col("all_saved") - F.col("chain_saved") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")), "trie")
    for path in (turns_path, prefixes_path, nodes_path):
        drop(spark, path)
    return out
