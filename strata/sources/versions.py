"""Table history: every state a table has had, as append-only frames read with joins.

Three frames describe a table: ``rows`` (what each commit added), ``closes`` (hashes of the rows a commit removed)
and ``commits`` (one small row per commit). Nothing is updated in place. A commit names its parent and the commit
ids it can see as ranges, so a read of any version is one filter on ``commit_id`` - a directory name on disk -
and one anti join against the closes. A commit that closes rows also names the commits they came from: rows of all
other commits are read without the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from strata.functions.text import record_hash
from strata.operators.silver import deduplicate

_RANGES = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
COMMITS = T.StructType([
    T.StructField("commit_id", T.LongType(), False),
    T.StructField("parent_id", T.LongType()),
    T.StructField("committed_at", T.TimestampNTZType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("visible", _RANGES),
    T.StructField("schema_json", T.StringType()),
    # Commits whose rows were closed by this one, or by commits forgotten since that this one sees.
    T.StructField("touched", _RANGES),
])


class UnknownVersion(ValueError):
    """The table has no such version."""


def extend(visible: Sequence[tuple[int, int]], commit_id: int) -> list[tuple[int, int]]:
    """Ranges a commit sees when its parent sees ``visible``."""
    if visible and visible[-1][1] == commit_id - 1:
        return [*visible[:-1], (visible[-1][0], commit_id)]
    return [*visible, (commit_id, commit_id)]


Ranges = Sequence[tuple[int, int]]


def _ranges(commit: Row, column: str = "visible") -> list[tuple[int, int]]:
    return [(r["first"], r["last"]) for r in commit[column]]


def _intersect(a: Ranges, b: Ranges) -> list[tuple[int, int]]:
    return [(max(i, k), min(j, m)) for i, j in a for k, m in b if max(i, k) <= min(j, m)]


def _subtract(a: Ranges, b: Ranges) -> list[tuple[int, int]]:
    out = list(a)
    for k, m in b:
        out = [part for i, j in out for part in ((i, min(j, k - 1)), (max(i, m + 1), j)) if part[0] <= part[1]]
    return out


def _merge(ranges: Ranges) -> list[tuple[int, int]]:
    """The same ids in as few ranges as possible."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _in_ranges(column: str, ranges: Ranges) -> Column:
    return reduce(lambda a, b: a | b, [F.col(column).between(lo, hi) for lo, hi in ranges], F.lit(False))


def _ntz(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def ranges_column(ranges: Ranges) -> Column:
    pairs = [F.struct(F.lit(a).cast("bigint").alias("first"), F.lit(b).cast("bigint").alias("last")) for a, b in ranges]
    return F.array(*pairs).cast(_RANGES)


def commit_row(
    spark: SparkSession, commit_id: int, parent_id: int | None, visible: Ranges, op: str, committed_at: datetime,
    schema_json: str | None = None, touched: Ranges = (),
) -> DataFrame:
    """One row of table metadata, made in the JVM."""
    return spark.range(0, 1, 1, 1).select(
        F.lit(commit_id).cast("bigint").alias("commit_id"), F.lit(parent_id).cast("bigint").alias("parent_id"),
        _ntz(committed_at).alias("committed_at"), F.lit(op).alias("op"), ranges_column(visible).alias("visible"),
        F.lit(schema_json).cast("string").alias("schema_json"), ranges_column(touched).alias("touched"))


@dataclass(frozen=True)
class History:
    """Rows (``commit_id``, ``record_hash`` and data), closes and commits of one table."""

    rows: DataFrame
    closes: DataFrame
    commits: DataFrame

    @cached_property
    def log(self) -> list[Row]:
        """Table metadata: one small row per commit, oldest first. The data itself stays on the executors."""
        found = self.commits.select("commit_id", "parent_id", "committed_at", "op", "visible", "touched")
        return sorted(found.collect(), key=lambda c: c["commit_id"])

    def head(self) -> Row:
        if not self.log:
            raise UnknownVersion("the table has no version")
        return self.log[-1]

    def version(self, commit_id: int) -> Row:
        for commit in self.log:
            if commit["commit_id"] == commit_id:
                return commit
        raise UnknownVersion(f"no version {commit_id}")

    def version_at(self, at: datetime) -> Row:
        """The newest version at or before a time, among all versions, also ones rolled back since."""
        found = [c for c in self.log if c["committed_at"] <= at]
        if not found:
            raise UnknownVersion(f"no version at or before {at}")
        return max(found, key=lambda c: (c["committed_at"], c["commit_id"]))

    def snapshots(self) -> DataFrame:
        """Version id, time in milliseconds and as ISO text."""
        at = F.col("committed_at")
        millis = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', committed_at)")
        return self.commits.select(
            F.col("commit_id").alias("snapshot_id"), millis.alias("timestamp_ms"),
            F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("timestamp"), "op", "parent_id",
        ).orderBy("timestamp_ms", "snapshot_id")

    def _state(self, commit: Row, rows: DataFrame | None = None) -> DataFrame:
        """Rows of a version, or those of ``rows`` that the version has not closed."""
        ranges = _ranges(commit)
        rows = self.rows.filter(_in_ranges("commit_id", ranges)) if rows is None else rows
        touched = self._touched(ranges)
        if not touched:
            return rows
        affected = _in_ranges("commit_id", touched)
        return rows.filter(~affected).unionByName(self._without_closed(rows.filter(affected), ranges))

    def _touched(self, ranges: Ranges) -> list[tuple[int, int]]:
        """Commits that lost rows to the commits in ``ranges``."""
        return _merge([r for c in self.log if any(a <= c["commit_id"] <= b for a, b in ranges)
                       for r in _ranges(c, "touched")])

    def _without_closed(self, rows: DataFrame, ranges: Ranges) -> DataFrame:
        # One row per closed hash: a hash closed many times must not multiply the join.
        closed = self.closes.filter(_in_ranges("commit_id", ranges)).groupBy(
            F.col("record_hash").alias("_hash")).agg(F.max("commit_id").alias("_closed_by"))
        return rows.join(closed, (F.col("record_hash") == F.col("_hash"))
                         & (F.col("_closed_by") > F.col("commit_id")), "left_anti")

    def at(self, commit_id: int) -> DataFrame:
        """The table as of a version."""
        return self._state(self.version(commit_id))

    def at_time(self, when: datetime) -> DataFrame:
        """The table as of a time."""
        return self._state(self.version_at(when))

    def current(self) -> DataFrame:
        return self._state(self.head())

    def rolled_back(self, commit_id: int, committed_at: datetime) -> History:
        """An old version made current again by a new, empty commit; the history stays."""
        new_id = self.head()["commit_id"] + 1
        visible = extend(_ranges(self.version(commit_id)), new_id)
        row = commit_row(self.commits.sparkSession, new_id, commit_id, visible, "rollback", committed_at)
        return History(self.rows, self.closes, self.commits.unionByName(row))

    def changes(self, first: int, last: int) -> DataFrame:
        """Rows added and removed between two versions, by content; ``change`` is 'added' or 'removed'.

        Of the commits both versions see, only those that one of them has closed rows of since are read, and of those
        only the rows with a closed hash. What is left is counted per row hash before the two sides meet, so rows that
        occur often cost one entry.
        """
        data = [c for c in self.rows.columns if c not in ("commit_id", "record_hash")]
        old, new = self.version(first), self.version(last)
        common = _intersect(_ranges(old), _ranges(new))
        recent = _subtract(_ranges(old), common) + _subtract(_ranges(new), common)
        reached = _intersect(common, self._touched(recent))
        sides = []
        for commit, sign in ((old, -1), (new, 1)):
            own = _subtract(_ranges(commit), common)
            parts = [self.rows.filter(_in_ranges("commit_id", own))]
            if reached:
                touched = self.closes.filter(_in_ranges("commit_id", recent)).select("record_hash").distinct()
                shared = self.rows.filter(_in_ranges("commit_id", reached))
                parts.append(shared.join(touched, "record_hash", "left_semi").select(*self.rows.columns))
            state = self._state(commit, reduce(DataFrame.union, parts))
            sides.append(state.withColumn("_sign", F.lit(sign)))
        net = sides[0].unionByName(sides[1]).groupBy("record_hash").agg(
            F.sum("_sign").alias("n"), *[F.first(c).alias(c) for c in data])
        change = F.when(F.col("n") > 0, F.lit("added")).otherwise(F.lit("removed"))
        return net.filter("n <> 0").select(change.alias("change"), F.abs("n").alias("copies"), *data)

    def expired(self, before: datetime) -> History:
        """Forget versions older than ``before``, except the current one.

        Rows no kept version can see go, and so do rows that a commit seen by every kept version closed.
        """
        head = self.head()
        kept = [c for c in self.log if c["committed_at"] >= before or c is head]
        forgotten = [c for c in self.log if c not in kept]
        seen = [_ranges(c) for c in kept]
        common = reduce(_intersect, seen)
        anywhere = _merge([r for ranges in seen for r in ranges])
        rows = self.rows.filter(_in_ranges("commit_id", anywhere))
        closes = self.closes.filter(_in_ranges("commit_id", anywhere))
        # Commits that never lost a row are not compared with the closes.
        lossy = _intersect(common, self._touched([(c["commit_id"], c["commit_id"]) for c in self.log]))
        if lossy:
            settled = _in_ranges("commit_id", lossy)
            rows = rows.filter(~settled).unionByName(self._without_closed(rows.filter(settled), common))
        # What forgotten commits touched is noted on the kept ones.
        noted = ranges_column(_merge([r for c in forgotten for r in _ranges(c, "touched")]))
        left = self.commits.filter(F.col("commit_id").isin([c["commit_id"] for c in kept])).withColumn(
            "touched", F.array_union("touched", noted))
        return History(rows, closes, left)


def latest_state(
    changes: DataFrame, keys: Sequence[str], order_by: Sequence[str], is_delete: Column,
) -> DataFrame:
    """Apply a change log: the last change of every key, without keys whose last change is a delete."""
    return deduplicate(changes, keys, order_by).filter(~F.coalesce(is_delete, F.lit(False)))
