"""Streaming jobs: many batches, late rows, restarts."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import Rule
from strata.streaming import jobs
from strata.streaming.metrics import RunMetrics
from tests.conftest import rows

START = datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp, k string, value double"


def put(spark, path, *data):
    """One file per call, in the order of the calls."""
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(minutes):
    return START + timedelta(minutes=minutes)


def stream(spark, path, files=1):
    return jobs.read_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, files)


def test_windows_come_out_once_closed_and_late_rows_do_not(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    put(spark, src, (1, at(1), "a", 1.0), (2, at(2), "a", 3.0))

    def run():
        metrics = jobs.window_metrics(stream(spark, src).withWatermark("ts", jobs.LATENESS), by=["k"])
        return jobs.run_available(metrics.writeStream.format("parquet").option("path", out).option("checkpointLocation", check))

    run()
    put(spark, src, (3, at(40), "a", 9.0))
    run()
    closed = [(at(0), at(5), "a", 2, 4.0, 2.0)]
    assert rows(spark.read.parquet(out), "window_start", "window_end", "k", "events", "total", "mean") == closed
    put(spark, src, (4, at(3), "a", 100.0), (5, at(39), "b", 1.0))
    query = run()
    assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 1
    assert rows(spark.read.parquet(out), "window_start", "window_end", "k", "events", "total", "mean") == closed


def test_sliding_windows_in_batch(spark):
    df = spark.createDataFrame([(1, at(7), "a", 1.0)], SCHEMA)
    out = jobs.window_metrics(df, by=["k"], length="10 minutes", slide="5 minutes")
    assert rows(out, "window_start") == [(at(0),), (at(5),)]


def test_duplicates_across_batches_and_in_one_batch(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))

    def envelopes(frame):
        return frame.select(
            F.col("id").cast("string").alias("event_id"), F.col("k").alias("event_type"),
            F.lit("2024-01-01T00:00:00Z").alias("event_timestamp"), F.lit("s").alias("source_system"),
            F.lit('{"a":" x "}').alias("payload"), "ts", "value")

    put(spark, src, *[(1, at(1), "t", 1.0)] * 50, (2, at(1), "t", 1.0), (3, at(1), "", 1.0))
    put(spark, src, (1, at(2), "t", 1.0), (4, at(2), "t", 1.0))
    clean = jobs.clean_events(envelopes(stream(spark, src)), F.lit("now"), ["value"])
    jobs.run_available(jobs.commit_batches(clean, out, check, lambda b: {"events": b}))
    stored = jobs.read_committed(spark, out, "events")
    assert rows(stored, "event_id", "payload", "validation_timestamp") == [
        (i, '{"a":"x"}', "now") for i in ("1", "2", "4")]


def test_replay_and_crash_between_writes(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    put(spark, src, (1, at(1), "a", 1.0))
    put(spark, src, (2, at(2), "b", 2.0))
    fail = {"on": True}

    def outputs(batch):
        if fail["on"] and batch.filter("id = 2").count():
            # The first table of the second batch is written, then the job dies before the commit.
            batch.write.mode("overwrite").parquet(f"{out}/left/run=lost/batch_id=1")
            raise RuntimeError("executor lost")
        return {"left": batch, "right": batch.filter("id > 0")}

    check = str(tmp_path / "check")
    with pytest.raises(Exception, match="executor lost"):
        jobs.run_available(jobs.commit_batches(stream(spark, src), out, check, outputs))
    assert rows(jobs.read_committed(spark, out, "left"), "id") == [(1,)]
    fail["on"] = False
    jobs.run_available(jobs.commit_batches(stream(spark, src), out, check, outputs))
    for again in range(2):
        assert rows(jobs.read_committed(spark, out, "left"), "id") == [(1,), (2,)]
        assert rows(jobs.read_committed(spark, out, "right"), "id") == [(1,), (2,)]
        with pytest.raises(Exception, match="another checkpoint"):
            jobs.run_available(jobs.commit_batches(stream(spark, src), out, str(tmp_path / f"strange{again}"), outputs))
        jobs.run_available(jobs.commit_batches(stream(spark, src), out, str(tmp_path / f"new{again}"), outputs, ["id"]))


def test_a_lost_checkpoint_with_other_cuts_repeats_nothing(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.range(30).repartition(3).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for turn, per_batch in enumerate((1, 3, 2)):
        read = jobs.read_stream(spark, src, schema, per_batch)
        jobs.run_available(jobs.commit_batches(read, out, str(tmp_path / f"check{turn}"), lambda b: {"t": b}, ["id"]))
        assert rows(jobs.read_committed(spark, out, "t")) == [(i,) for i in range(30)]


def test_a_new_checkpoint_reads_only_batches_in_its_range(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for hour in range(4):
        put(spark, src, *[(hour * 10 + i, at(hour * 60 + i), "a", 1.0) for i in range(3)])
    put(spark, src, (90, None, "a", 1.0))

    def run(check):
        return jobs.run_available(jobs.commit_batches(
            stream(spark, src), out, str(tmp_path / check), lambda b: {"t": b, "by": b.select("id")}, ["id"], "ts"))

    run("first")
    asked, real = [], jobs.overlapping

    def counting(*args):
        found = real(*args)
        asked.append(found.count())
        return found

    monkeypatch.setattr(jobs, "overlapping", counting)
    put(spark, src, (11, at(61), "a", 1.0), (12, at(500), "a", 1.0))
    run("second")
    # Five batches meet themselves, the sixth reaches from the second hour to the end.
    assert asked == [1, 1, 1, 1, 1, 3]
    want = [(h * 10 + i,) for h in range(4) for i in range(3)]
    # The key is id and time, so an id at another time is another row; the table without times has just the ids.
    assert rows(jobs.read_committed(spark, out, "t"), "id") == sorted([*want, (12,), (90,)])
    assert rows(jobs.read_committed(spark, out, "by"), "id") == sorted([*want, (90,)])
    monkeypatch.setattr(jobs, "_DIRECTORIES", 0)
    run("third")
    assert jobs.read_committed(spark, out, "t").count() == len(want) + 2


def test_window_metrics_keep_small_values_and_missing_ones(spark):
    data = [(datetime(2024, 1, 1), v, "k") for v in (0.004, 0.004, None, 1e17)] + [(datetime(2024, 1, 1), None, "none")]
    df = spark.createDataFrame(data, "ts timestamp, value double, event_type string")
    got = {r.event_type: r for r in jobs.window_metrics(df.filter("value < 1 or value is null")).collect()}
    assert (got["k"].events, got["k"].total, got["k"].mean) == (3, 0.008, 0.004)
    assert (got["none"].events, got["none"].total, got["none"].mean) == (1, None, None)
    exact = {r.event_type: r for r in jobs.window_metrics(df, scale=3).collect()}
    assert exact["k"].total == pytest.approx(1e17) and exact["k"].events == 4


def test_quality_per_batch(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    put(spark, src, (1, at(1), "a", 1.0))
    put(spark, src, (2, at(2), None, 2.0))
    jobs.run_available(jobs.commit_batches(stream(spark, src), out, check, jobs.quality_batches([Rule("not_null", "k")], "bronze", "t")))
    assert rows(jobs.read_committed(spark, out, "results"), "passed", "total_rows") == [(False, 1), (True, 1)]
    assert jobs.read_committed(spark, out, "alerts").count() == 1


def test_batch_size_is_capped_by_files(spark, tmp_path):
    src = str(tmp_path / "src")
    for i in range(3):
        put(spark, src, (i, at(i), "a", 1.0))
    query = jobs.run_available(jobs.commit_batches(stream(spark, src, 1), str(tmp_path / "out"), str(tmp_path / "check"), lambda b: {"t": b}))
    assert [p.numInputRows for p in query.recentProgress] == [1, 1, 1]


def test_anomalies(spark):
    values = [10.0, 11.0, 9.0, 10.0, 11.0, 9.0, 10.0, 50.0, 10.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)] + [("flat", i, 5.0) for i in range(9)], "k string, i int, v double")
    out = jobs.anomaly_flags(df, ["k"], "i", "v", F.floor(F.col("i") / 2), history=5, bound=3.0)
    assert rows(out.filter("anomaly"), "k", "i") == [("a", 7)]
    assert out.filter("i < 5 AND z IS NOT NULL").count() == 0 and out.count() == 18


@pytest.mark.parametrize("cuts", [1, 4])
def test_anomalies_of_a_stream_are_those_of_the_batch(spark, tmp_path, cuts):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    values = [10.0, 11.0, 9.0, None, 11.0, 9.0, 10.0, 11.0, 50.0, 10.0, 0.1, 0.1, 0.1, 0.1, 0.1, 7.0]
    data = [(i, at(5 * i), k, v) for i, v in enumerate(values) for k in "ab" if (k, i) != ("b", 2)]
    size = -(-len(data) // cuts)
    for first in range(0, len(data), size):
        put(spark, src, *data[first:first + size][::-1])
    flagged = jobs.anomaly_stream(stream(spark, src), ["k"], "ts", "value", history=4, bound=2.0)
    query = jobs.run_available(flagged.writeStream.format("parquet").option("path", out).option("checkpointLocation", check))
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == cuts
    batch = spark.createDataFrame(data, SCHEMA)
    want = jobs.anomaly_flags(batch, ["k"], "ts", "value", F.hour("ts"), history=4, bound=2.0)
    columns = ["k", "ts", "value", "history", F.round("expected", 9), F.round("spread", 9), F.round("z", 9), "anomaly"]
    got = rows(spark.read.parquet(out), *columns)
    assert got == rows(want, *columns) and sum(r[-1] for r in got) > 0


def test_run_metrics_are_landed_and_count_late_rows(spark, tmp_path):
    src, out, check, landed = (str(tmp_path / n) for n in ("src", "out", "check", "landed"))
    with RunMetrics(spark, landed, every=1) as metrics:
        for data in ([(1, at(0), "a", 1.0), (2, at(60), "a", 1.0)],
                     [(3, at(1), "a", 1.0), (4, at(2), "a", 1.0), (5, at(59), "a", 1.0)]):
            put(spark, src, *data)
            distinct = stream(spark, src).withWatermark("ts", jobs.LATENESS).dropDuplicatesWithinWatermark(["id"])
            query = jobs.run_available(distinct.writeStream.queryName("late").format("parquet").option("path", out)
                                       .option("checkpointLocation", check))
            metrics.landed(query)
    got = spark.read.parquet(landed).filter("input_rows > 0")
    assert rows(got, "query", "input_rows", "late_rows") == [("late", 2, 0), ("late", 3, 2)]
    assert got.filter("duration_ms > 0 AND add_batch_ms <= duration_ms").count() == 2
    with RunMetrics(spark, landed) as metrics, pytest.raises(TimeoutError):
        metrics.landed(query, seconds=0.1)
