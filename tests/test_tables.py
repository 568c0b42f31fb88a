"""Files, partitions, schemas and table history."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from strata.cluster import clear_scratch, scratch_path, work_dir
from strata.functions.text import record_hash
from strata.sources import layers, tables
from strata.sources.versions import History, UnknownVersion, commit_row, extend, latest_state
from tests.conftest import rows

D = [datetime(2024, 1, d) for d in range(1, 20)]
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def files(path: str) -> list[str]:
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


# ---- files and layers

def test_bad_lines_are_kept(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    (tmp_path / "a.csv").write_text("id,v\n1,x\nnope,y\n")
    out = layers.read_files(spark, str(tmp_path / "a.csv"), "csv", schema)
    assert rows(out) == [(None, "y", "nope,y"), (1, "x", None)]
    (tmp_path / "a.json").write_text('{"id":1,"v":"x"}\n{broken\n')
    assert rows(layers.read_files(spark, str(tmp_path / "a.json"), "json", schema)) == [
        (None, None, "{broken"), (1, "x", None)]
    with pytest.raises(ValueError):
        layers.read_files(spark, "x", "orc", schema)


def test_files_land_in_a_layer_and_count(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType())])
    (tmp_path / "a.csv").write_text("id,d\n1,2024-01-02\nnope,2024-01-02\n2,\n")
    (tmp_path / "a.json").write_text('{"id":3,"d":"2023-05-06"}\n{broken\n')
    spark.createDataFrame([(4, None)], schema).write.parquet(str(tmp_path / "p"))
    target, bad = str(tmp_path / "raw"), str(tmp_path / "bad")
    counts = [layers.ingest_files(spark, str(tmp_path / name), kind, schema, target, "bronze", "d", "year", bad)
              for name, kind in (("a.csv", "csv"), ("a.json", "json"), ("p", "parquet"))]
    assert counts == [(2, 1), (1, 1), (1, 0)] and all("snappy" in f for f in files(target))
    assert rows(spark.read.parquet(target), "id") == [(1,), (2,), (3,), (4,)] and "d_year=2023" in os.listdir(target)
    kept = spark.read.parquet(bad)
    assert rows(kept, layers.CORRUPT) == [("nope,2024-01-02",), ("{broken",)]
    assert {r[0].rsplit("/", 1)[1] for r in kept.select("source_file").collect()} == {"a.csv", "a.json"}
    (tmp_path / "none.csv").write_text("id,d\n")
    assert layers.ingest_files(spark, str(tmp_path / "none.csv"), "csv", schema, str(tmp_path / "r2")) == (0, 0)


@pytest.mark.parametrize("layer, codec, part", [("bronze", "snappy", "ts_day=2024-01-31"),
                                                ("silver", "zstd", "ts_day=2024-01-31"), ("gold", "zstd", "ts_month=2024-01")])
def test_layer_writes_in_its_codec_and_layout(spark, path, layer, codec, part):
    df = spark.range(3).withColumn("ts", F.lit("2024-01-31 10:00:00").cast("timestamp_ntz"))
    layers.write_layer(df, path, layer, "ts")
    layers.write_layer(df, path, layer, "ts")
    assert os.listdir(f"{path}/{part}") and all(codec in f for f in files(path))
    assert spark.read.parquet(path).count() == 6


def test_overwriting_one_day_leaves_the_others(spark, path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, d string").withColumn("ts", F.col("d").cast("timestamp"))
    layers.write_layer(df, path, "silver", "ts")
    layers.write_layer(df.filter("id = 2").withColumn("id", F.lit(9)), path, "silver", "ts", mode="overwrite")
    assert rows(spark.read.parquet(path), "id") == [(1,), (9,)]


def test_scan_limit_zero_and_none(spark):
    df = spark.range(10)
    assert layers.scan(df, limit=0).count() == 0
    assert layers.scan(df).count() == 10
    assert rows(layers.scan(df, ["id"], "id > 3", [F.desc("id")], 2)) == [(8,), (9,)]


def test_transforms(spark):
    df = spark.createDataFrame([("2024-03-05 07:08:09",)], "t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    out = layers.with_partitions(df, [("ts", x) for x in ("year", "month", "day", "hour")] + [("t", "identity")]).first()
    assert out[2:] == ("2024", "2024-03", "2024-03-05", "2024-03-05-07", "2024-03-05 07:08:09")
    with pytest.raises(ValueError):
        layers.with_partitions(df, [("ts", "bucket")])


def test_schema_changes(spark):
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("x", T.DoubleType())])
    assert rows(layers.read_as(old, schema, {"name": "title"})) == [(1, "a", None)]
    with pytest.raises(ValueError, match="cannot change"):
        layers.read_as(old, T.StructType([T.StructField("id", T.ShortType())]))
    with pytest.raises(ValueError, match="nullable"):
        layers.read_as(old, T.StructType([T.StructField("new", T.LongType(), False)]))


def test_file_stats(spark, path):
    spark.range(100).repartition(4).write.parquet(path)
    got = tables.file_stats(spark, path).first()
    sizes = sum(os.path.getsize(f"{path}/{f}") for f in files(path))
    assert (got["row_count"], got["file_count"], got["size_bytes"]) == (100, 4, sizes)


def test_layouts_live_side_by_side(spark, path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("k", T.StringType())])
    df = spark.createDataFrame([(1, D[0], "a"), (2, D[1], "b")], schema)
    tables.write(df, f"{path}/1", [("ts", "day")])
    tables.write(df, f"{path}/2", [("ts", "day"), ("k", "identity")])
    assert rows(tables.read_layouts(spark, f"{path}/1", f"{path}/2"), "id", "k_identity") == [(1, None), (1, "a"), (2, None), (2, "b")]


# ---- tables

def test_write_appends_and_replaces_directories(spark, path):
    spec = [("v", "identity")]
    tables.write(frame(spark, (1, "a"), (2, "b")), path, spec)
    tables.write(frame(spark, (3, "a")), path, spec)
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]
    tables.write(frame(spark, (9, "a")), path, spec, "overwrite")
    assert rows(spark.read.parquet(path), "id") == [(2,), (9,)]
    tables.write(frame(spark, (5, "z")), f"{path}-plain", mode="overwrite")
    tables.write(frame(spark, (6, "z")), f"{path}-plain", mode="overwrite")
    assert rows(spark.read.parquet(f"{path}-plain"), "id") == [(6,)]


def test_delete_keeps_rows_without_an_answer(spark, path):
    tables.write(frame(spark, (1, "a"), (1, "a"), (2, None), (3, "c")), path)
    tables.delete_where(spark, path, "v = 'a'", f"{path}-new")
    assert rows(spark.read.parquet(f"{path}-new")) == [(2, None), (3, "c")]


def test_repeated_compaction_keeps_file_sizes(spark, path):
    data = spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    data.repartition(13).write.parquet(path)
    size = tables.file_stats(spark, path).first()["size_bytes"]
    counts = []
    for turn in range(3):
        tables.compact(spark, path, ["id"], f"{path}-{turn}", target_bytes=size // 3)
        path = f"{path}-{turn}"
        counts.append(tables.file_stats(spark, path).first()["file_count"])
    assert counts[1] == counts[2] <= counts[0] <= 4 and rows(spark.read.parquet(path)) == rows(data)


# ---- history

def test_visible_ranges_stay_short():
    assert extend([(0, 4)], 5) == [(0, 5)]
    assert extend([(0, 2)], 5) == [(0, 2), (5, 5)]


@pytest.fixture
def history(spark):
    """1: rows a, a, b; 2: row c; 3: closes a; 4: a again; 5: back to 2."""
    data = [(1, "a", 1), (1, "a", 1), (2, "b", 1), (3, "c", 2), (1, "a", 4)]
    stored = spark.createDataFrame(data, "id long, v string, commit_id long").withColumn("record_hash", record_hash(SCHEMA))
    closes = stored.where("commit_id = 1 and id = 1").select("record_hash", F.lit(3).cast("long").alias("commit_id")).distinct()
    made = [(1, None, [(1, 1)], "append", ()), (2, 1, [(1, 2)], "append", ()), (3, 2, [(1, 3)], "delete", [(1, 1)]),
            (4, 3, [(1, 4)], "append", ()), (5, 2, [(1, 2), (5, 5)], "rollback", ())]
    commits = None
    for n, parent, seen, op, touched in made:
        row = commit_row(spark, n, parent, seen, op, D[n], None, touched)
        commits = row if commits is None else commits.unionByName(row)
    return History(stored, closes, commits)


def data_of(df):
    return rows(df, "id", "v")


def test_versions_of_a_history(spark, history):
    states = {n: data_of(history.at(n)) for n in range(1, 6)}
    assert states == {1: [(1, "a"), (1, "a"), (2, "b")], 2: [(1, "a"), (1, "a"), (2, "b"), (3, "c")], 3: [(2, "b"), (3, "c")],
                      4: [(1, "a"), (2, "b"), (3, "c")], 5: [(1, "a"), (1, "a"), (2, "b"), (3, "c")]}
    assert data_of(history.current()) == states[5] and data_of(history.at_time(datetime(2024, 1, 4, 12))) == states[3]
    with pytest.raises(UnknownVersion):
        history.at(99)
    with pytest.raises(UnknownVersion):
        history.at_time(datetime(2000, 1, 1))
    snapshots = history.snapshots().collect()
    assert [r["op"] for r in snapshots] == ["append", "append", "delete", "append", "rollback"]
    assert snapshots[0]["timestamp_ms"] == 1704153600000 and snapshots[0]["timestamp"] == "2024-01-02T00:00:00.000"


def test_changes_between_versions(spark, history):
    assert rows(history.changes(1, 4), "change", "copies", "id", "v") == [("added", 1, 3, "c"), ("removed", 1, 1, "a")]
    assert rows(history.changes(4, 1), "change", "copies", "id", "v") == [("added", 1, 1, "a"), ("removed", 1, 3, "c")]
    assert history.changes(2, 2).count() == 0 and history.changes(2, 5).count() == 0


def unreadable(history, commit):
    """The history with rows of one commit that can't be read."""
    value = F.when(F.col("commit_id") == commit, F.raise_error(F.lit("was read"))).otherwise(F.col("v"))
    return History(history.rows.withColumn("v", value), history.closes, history.commits)


def test_changes_leave_unchanged_history_unread(spark, history):
    assert rows(unreadable(history, 2).changes(2, 4), "change", "copies", "id", "v") == [("removed", 1, 1, "a")]
    with pytest.raises(Exception, match="was read"):
        unreadable(history, 2).changes(1, 4).collect()
    # What a forgotten commit closed is known from the commits that are left.
    short = unreadable(history.expired(D[4]), 2)
    assert rows(short.changes(4, 5), "change", "copies", "id", "v") == rows(history.changes(4, 5), "change", "copies", "id", "v")


def test_expiry_keeps_reads(spark, history):
    kept = history.expired(D[4])
    assert data_of(kept.at(4)) == [(1, "a"), (2, "b"), (3, "c")] and data_of(kept.current()) == data_of(history.at(2))
    with pytest.raises(UnknownVersion):
        kept.at(1)


def test_latest_state_drops_deleted_keys(spark):
    df = spark.createDataFrame([(1, 1, "i"), (1, 2, "d"), (2, 1, "d"), (2, 2, "i"), (3, 1, None)], "k int, seq int, op string")
    assert rows(latest_state(df, ["k"], ["seq"], F.col("op") == "d"), "k") == [(2,), (3,)]


# ---- shared folder

class FakeSession:
    """The parts of a session the folder lookup asks."""

    def __init__(self, master: str, **conf: str) -> None:
        self.master, self.settings, self.folder = master, conf, None
        self.conf, self.sparkContext, self.applicationId = self, self, "app-1"

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_work_folder_comes_from_the_session():
    named = FakeSession("spark://h:7077", spark_checkpoint_dir="hdfs://nn/work/")
    assert work_dir(named) == "hdfs://nn/work" and named.folder == "hdfs://nn/work/"
    assert scratch_path(named, "x").startswith("hdfs://nn/work/strata-app-1/x-")
    assert scratch_path(named, "x") != scratch_path(named, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(FakeSession("spark://h:7077"))
    assert work_dir(FakeSession("local[2]"))


def test_scratch_tables_can_be_cleared(spark):
    path = scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    clear_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))
