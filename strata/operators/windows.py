"""Window results for groups too large for one task.

A plain window sends a whole group to one task. Here a group is cut into buckets by ``split``, a column expression
that never decreases along the order (a day of a timestamp, a band of a price, or, where the data is uneven, the
pieces of ``with_pieces``). Each bucket is one window partition, and what it needs from the earlier buckets is computed from one summary row per bucket: that summary
is small, and so is the window over it. Results equal those of the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

_FIRST = Window.unboundedPreceding


def _with_carry(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], split: Column,
    summary: Mapping[str, Column], carry: Callable[[WindowSpec, WindowSpec], Mapping[str, Column]],
    descending: bool = False,
) -> tuple[DataFrame, WindowSpec, Column]:
    """Put one carry row in front of every bucket, holding what the buckets before it add up to.

    ``carry`` gets a window over the earlier buckets and one over all buckets of the key.
    """
    rows = df.withColumn("_split", split)
    per_bucket = rows.groupBy(*keys, "_split").agg(*[c.alias(n) for n, c in summary.items()])
    along = F.desc_nulls_last("_split") if descending else F.asc_nulls_first("_split")
    earlier = Window.partitionBy(*keys).orderBy(along).rowsBetween(_FIRST, -1)
    every = Window.partitionBy(*keys)
    carried = carry(earlier, every)
    heads = per_bucket.select(*keys, "_split", F.struct(*[c.alias(n) for n, c in carried.items()]).alias("_carry"),
                              F.lit(0).alias("_row"))
    both = rows.withColumn("_row", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    window = Window.partitionBy(*keys, "_split").orderBy("_row", *order_by)
    return both, window, F.first("_carry").over(window.rowsBetween(_FIRST, 0))


def with_pieces(df: DataFrame, keys: Sequence[str], order: str, rows_per_piece: int = 1_000_000, column: str = "_piece",
                most: int = 4096) -> DataFrame:
    """The rows with a bucket number that follows the data: each group is cut at quantiles of ``order``, so a hot day or
    price band is many buckets. Use ``F.col(column)`` as the ``split``.

    Pieces are about equal, but equal values share one, as ranks need them to. A NULL order value is a piece before the
    others. One scan counts, one sketches the quantiles of all groups; both are combined before they are shuffled.
    """
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    pieces = min(most, -(-largest // rows_per_piece))
    if pieces < 2:
        return df.withColumn(column, F.when(F.col(order).isNotNull(), 0))
    shares = F.array(*[F.lit(k / pieces) for k in range(1, pieces)])
    cuts = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.array_sort(F.array_distinct(F.percentile_approx(order, shares, 10 * pieces))).alias("_cuts"))
    step = math.isqrt(pieces)
    cuts = cuts.withColumn("_steps", F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / step).cast("int")), lambda i: F.get("_cuts", i * step)))
    joined = df.join(cuts, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], "left")
    # Cuts below the value, found in two steps: among every so many of them, and then between two of those.
    whole = F.size(F.filter("_steps", lambda c: c < F.col(order)))
    first = F.greatest(whole - 1, F.lit(0)) * step
    piece = first + F.size(F.filter(F.slice("_cuts", first + 1, step), lambda c: c < F.col(order)))
    return joined.withColumn(column, F.when(F.col(order).isNotNull(), F.coalesce(piece, F.lit(0)))).select(*df.columns, column)


def _finish(df: DataFrame) -> DataFrame:
    return df.filter("_row = 1").drop("_row", "_split", "_carry", "_carried")


def running(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], split: Column, sums: Mapping[str, Column],
) -> DataFrame:
    """Running totals per key, from the first row up to and including the current one."""
    both, window, carried = _with_carry(
        df, keys, [F.col(c) for c in order_by], split,
        {n: F.sum(c) for n, c in sums.items()},
        lambda earlier, _: {n: F.sum(n).over(earlier) for n in sums})
    out = both.withColumn("_carried", carried)
    zero = F.lit(0)
    for name, column in sums.items():
        here = F.sum(F.when(F.col("_row") == 1, column)).over(window.rowsBetween(_FIRST, 0))
        before = F.col("_carried")[name]
        # NULL only while no value has been seen at all, as with a plain running sum.
        out = out.withColumn(name, F.when(here.isNotNull() | before.isNotNull(),
                                          F.coalesce(here, zero) + F.coalesce(before, zero)))
    return _finish(out)


def ranks(
    df: DataFrame, keys: Sequence[str], order: str, split: Column, ties: Sequence[str] = (),
    descending: bool = False, tiles: int | None = None,
) -> DataFrame:
    """``row_number``, ``rank``, ``dense_rank`` by ``order`` and, if asked for, ``ntile``.

    ``split`` must depend on ``order`` alone, so that equal values share a bucket.
    """
    direction = F.desc_nulls_last if descending else F.asc_nulls_first
    both, window, carried = _with_carry(
        df, keys, [direction(order), *[F.col(t) for t in ties]], split,
        # A NULL order value is one more distinct value.
        {"_n": F.count(F.lit(1)),
         "_d": F.count_distinct(order) + F.max(F.col(order).isNull().cast("int"))},
        lambda earlier, every: {
            "rows": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "values": F.coalesce(F.sum("_d").over(earlier), F.lit(0)),
            "total": F.sum("_n").over(every)},
        descending)
    by_value = Window.partitionBy(*keys, "_split").orderBy("_row", direction(order))
    c = F.col("_carried")
    out = both.withColumns({
        "_carried": carried,
        "row_number": F.row_number().over(window),
        "rank": F.rank().over(by_value),
        "dense_rank": F.dense_rank().over(by_value),
    }).withColumns({
        # The carry row is the first of its bucket and takes number 1.
        "row_number": (c["rows"] + F.col("row_number") - 1).cast("bigint"),
        "rank": (c["rows"] + F.col("rank") - 1).cast("bigint"),
        "dense_rank": (c["values"] + F.col("dense_rank") - 1).cast("bigint"),
    })
    if tiles:
        place, small, extra = F.col("row_number") - 1, F.floor(c["total"] / tiles), c["total"] % tiles
        wide = extra * (small + 1)
        out = out.withColumn("ntile", F.when(place < wide, F.floor(place / (small + 1)) + 1)
                             .otherwise(extra + F.floor(F.try_divide(place - wide, small)) + 1).cast("bigint"))
    return _finish(out)


def neighbours(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], split: Column,
    columns: Mapping[str, Callable[[WindowSpec], Column]], before: int = 0, after: int = 0,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` rows ahead (lag, lead, moving frames).

    Each bucket borrows that many rows from the buckets around it and drops them again afterwards.
    """
    plain = df.withColumn("_split", split)
    names = [*order_by, *[c for c in df.columns if c not in order_by]]
    out = plain.withColumn("_row", F.lit(1))
    for count, ascending in ((before, False), (after, True)):
        if not count:
            continue
        toward = F.asc_nulls_first if ascending else F.desc_nulls_last
        edge = Window.partitionBy(*keys, "_split").orderBy(*[toward(c) for c in order_by])
        # At most ``count`` rows per bucket and map task reach the shuffle, and ``count`` per bucket leave it.
        kept = plain.withColumn("_rn", F.row_number().over(edge)).filter(F.col("_rn") <= count)
        per_bucket = kept.groupBy(*keys, "_split").agg(
            F.sort_array(F.collect_list(F.struct("_rn", *names))).alias("_edge"))
        nearest = Window.partitionBy(*keys).orderBy(toward("_split")).rowsBetween(1, count)
        # Buckets hold at least one row, so ``count`` buckets hold at least ``count`` rows, nearest first.
        borrowed = per_bucket.withColumn("_near", F.flatten(F.collect_list("_edge").over(nearest))).select(
            "_split", F.explode(F.slice("_near", 1, count)).alias("_r"))
        out = out.unionByName(borrowed.select("_split", F.lit(0).alias("_row"), *[F.col(f"_r.{n}") for n in names]))
    window = Window.partitionBy(*keys, "_split").orderBy(*order_by)
    return _finish(out.withColumns({n: make(window) for n, make in columns.items()}))


def as_of(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
    columns: Sequence[str], split: Callable[[Column], Column], tie: str | None = None,
) -> DataFrame:
    """For every left row the latest right row of its key at or before its time; NULLs when there is none.

    Both sides go through one window instead of a range join. ``split`` maps a time to its bucket; ``tie`` picks
    the last of several right rows with one time.
    """
    picked = F.struct(*columns)
    order = F.col(tie) if tie else F.lit(0)
    ours = left.withColumns({"_t": F.col(left_time), "_side": F.lit(1)})
    theirs = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
                          picked.alias("_found"), order.alias("_tie"))
    union = ours.unionByName(theirs, allowMissingColumns=True)
    both, window, carried = _with_carry(
        union, keys, [F.col("_t"), F.col("_side"), F.col("_tie")], split(F.col("_t")),
        {"_last": F.max_by("_found", F.when(F.col("_side") == 0, F.struct("_t", "_tie")))},
        lambda earlier, _: {"last": F.last("_last", ignorenulls=True).over(earlier)})
    here = F.last("_found", ignorenulls=True).over(window.rowsBetween(_FIRST, 0))
    out = both.withColumn("_match", F.coalesce(here, carried["last"])).filter("_side = 1")
    out = out.withColumns({c: F.col("_match")[c] for c in columns})
    return _finish(out).drop("_t", "_side", "_found", "_tie", "_match")
