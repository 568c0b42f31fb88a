"""Events and messages on hand-made rows."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.functions import events as ev
from strata.operators import events, messages
from strata.sources import kafka
from tests.conftest import rows

GOOD = '{"event_id":"1","event_type":"user_action","event_timestamp":"2024-01-01T00:00:00Z","source_system":"web","payload":{"user_id":"u"}}'


def envelopes(spark, *texts):
    return events.parse(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_parse_fills_defaults_and_keeps_bad_text(spark):
    out = envelopes(spark, GOOD, "no json", '{"event_id":"2","metadata":{"a":1},"schema_version":"2.0"}')
    got = {r["event_id"]: r for r in out.collect()}
    assert got["1"]["metadata"] == {} and got["1"]["schema_version"] == "1.0"
    assert got["1"]["payload"] == '{"user_id":"u"}' and got["1"]["_corrupt_record"] is None
    assert got["2"]["metadata"] == {"a": "1"} and got["2"]["schema_version"] == "2.0"
    assert got[None]["_corrupt_record"] == "no json"


def errors_of(spark, **fields):
    base = {"event_id": "1", "event_type": "t", "event_timestamp": "2024-01-01T00:00:00Z", "source_system": "s", "payload": "{}"}
    base.update(fields)
    schema = ", ".join(f"{k} string" for k in base)
    return events.validate(spark.createDataFrame([tuple(base.values())], schema)).first()["errors"]


def test_validation_messages_and_order(spark):
    assert errors_of(spark) == []
    assert errors_of(spark, event_id="", event_timestamp="invalid-timestamp", payload="not a dict") == [
        "event_id is required", "payload must be a dictionary", "event_timestamp must be valid ISO 8601 format"]
    assert errors_of(spark, event_timestamp="") == [
        "event_timestamp is required", "event_timestamp must be valid ISO 8601 format"]
    assert errors_of(spark, event_timestamp=None, payload=None, source_system=None) == [
        "event_timestamp is required", "source_system is required", "payload must be a dictionary",
        "event_timestamp must be valid ISO 8601 format"]
    for payload in ("[1]", '"text"', "5", "null", ""):
        assert errors_of(spark, payload=payload) == ["payload must be a dictionary"]


def test_iso_timestamps_as_python_reads_them(spark):
    texts = ["2024-01-01", "2024", "2024-01", "20240101", "2024-13-01", "2024-02-30", "2024-02-29", "2023-02-29",
             "2024-01-01T10", "2024-01-01T10:30", "2024-01-01T10:30:15", "2024-01-01T10:30:15.5", "2024-01-01T10:30:15,123456",
             "2024-01-01T10:30:15Z", "2024-01-01T10:30:15+02:00", "2024-01-01T10:30:15+0200", "2024-01-01T10:30:15+02",
             "2024-01-01 10:30", "2024-01-01x10:30", "2024-01-01T", "2024-01-01T25:00", "2024-01-01T10:60", "2024-01-01T10:30:60",
             "20240101T103015", "20240101T10:30:15", "2024-01-01T1030", "2024-01-01T10:3015", "2024-W05-1", "2024W051", "2024-W05",
             "2024-W53-1", "2020-W53-1", "2024-W00-1", "2024-W05-8", "0000-01-01", "garbage", "2024-1-1", " 2024-01-01",
             "2024-01-01T10:30:15 ", "2024-01-01Z", "2024-01-01T10:30:15-23:59", "2024-01-01T10:30:15+24:00", "2024-0101"]

    def python_reads(text):
        try:
            datetime.fromisoformat(text.replace("Z", "+00:00"))
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["ok"] for r in df.withColumn("ok", ev.is_iso_timestamp(F.col("t"))).collect()}
    assert got == {t: python_reads(t) for t in texts}


def test_serialize_round_trip(spark):
    parsed = envelopes(spark, GOOD.replace('{"user_id":"u"}', '{"user_id":"u \\"q\\"","n":[1,{"x":null}]}'))
    again = events.parse(events.serialize(parsed).select("value"))
    others = [c for c in ev.ENVELOPE_COLUMNS if c != "payload"]
    assert rows(again, *others) == rows(parsed, *others)
    # Members of an object may change places.
    assert json.loads(again.first()["payload"]) == json.loads(parsed.first()["payload"])
    text = events.serialize(parsed.withColumn("payload", F.lit('plain "text"'))).first()["value"]
    assert text.endswith('"payload":"plain \\"text\\""}')


@pytest.mark.parametrize("kind, topic", [*ev.TOPIC_ROUTES.items(), ("other", "raw-events"), (None, "raw-events")])
def test_routes(spark, kind, topic):
    df = spark.createDataFrame([(kind,)], "event_type string")
    assert events.route(df).first()["topic"] == topic
    assert events.route(df, "mine").first()["topic"] == "mine"


def test_enrich_overrides_and_keeps(spark):
    parsed = envelopes(spark, GOOD.replace('"payload"', '"metadata":{"a":"1","producer_version":"0"},"payload"'))
    meta = events.enrich(parsed, F.lit("now")).first()["metadata"]
    assert meta == {"a": "1", "ingestion_timestamp": "now", "ingestion_system": "dataplatform", "producer_version": "1.0.0"}
    assert parsed.first()["metadata"] == {"a": "1", "producer_version": "0"}


def test_wrap_raw_uses_given_ids(spark):
    df = spark.createDataFrame([("a", '{"x":1}'), (None, '{"x":2}')], "id string, data string")
    out = events.wrap_raw(df, F.col("data"), "app", F.lit("now"), event_id=F.col("id"), position=[F.col("data")]).collect()
    assert out[0]["event_id"] == "a" and len(out[1]["event_id"]) == 32
    assert out[0]["event_type"] == "raw_data" and out[0]["schema_version"] == "1.0"


def test_publish_counts(spark):
    df = envelopes(spark, GOOD, GOOD.replace('"1"', '""'), GOOD.replace("user_action", "transaction"))
    totals = events.publish_totals(events.publish(df, F.lit("now")))
    assert rows(totals) == [("raw-events", 2, 1, 1), ("raw-transactions", 1, 1, 0)]
    unchecked = events.publish_totals(events.publish(df, F.lit("now"), check=False))
    assert sum(r["failed"] for r in unchecked.collect()) == 0


def test_trim_payload_json_touches_strings_of_the_first_level_only(spark):
    payloads = ['{"a":"  x ","b":1.50,"c":{"d":" y "},"e":[" z "],"f":null,"g":true,"h":" \\"q\\" "}', "[1, 2]", "plain ", None]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    out = [r[0] for r in df.select(events.trim_payload_json(F.col("p"))).collect()]
    assert json.loads(out[0]) == {"a": "x", "b": 1.5, "c": {"d": " y "}, "e": [" z "], "f": None, "g": True, "h": '"q"'}
    assert out[1:] == ["[1, 2]", "plain ", None]


# ---- messages

def log(spark, *rows_):
    return spark.createDataFrame(
        [(k, v, t, p, o, None, None) for t, p, o, k, v in rows_], kafka.LOG_SCHEMA)


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame([("k1", 5, "x")], "id string, n int, h string")
    out = messages.encode(df, ["id", "n"], "id", ["h"])
    decoded = messages.decode(out.select("key", "value", "headers")).first()
    assert decoded["key"] == "k1" and decoded["value"] == '{"id":"k1","n":5}'
    assert decoded["headers"] == {"h": "x"} and decoded["decode_error"] is None
    assert bytes(messages.encode(df, "h").first()["value"]) == b'"x"'
    assert bytes(messages.encode(df, "h", value_format="string").first()["value"]) == b"x"
    assert messages.encode(df, "h").first()["key"] is None
    with pytest.raises(ValueError):
        messages.encode(df, "h", value_format="avro")


def test_decode_keeps_rows_it_cannot_read(spark):
    df = log(spark, ("t", 0, 0, b"k", b"{bad"), ("t", 0, 1, None, b"\xff\xfe"), ("t", 0, 2, b"k", None), ("t", 0, 3, b"k", b"[1]"))
    assert rows(messages.decode(df), "offset", "value", "decode_error") == [
        (0, "{bad", "value is not JSON"), (1, None, "value is not UTF-8"), (2, None, None), (3, "[1]", None)]
    assert messages.decode(df).first()["headers"] == {} and messages.decode(df).first()["timestamp"] is None
    assert "decode_error" not in messages.decode(df, "bytes").columns


def test_header_sent_twice_keeps_the_last(spark):
    df = spark.createDataFrame([(b"k", b"1", [("a", b"1"), ("b", b"2"), ("a", b"3")])],
                               "key binary, value binary, headers array<struct<key:string,value:binary>>")
    assert messages.decode(df).first()["headers"] == {"a": "3", "b": "2"}


def test_offsets_lag_and_replay(spark):
    df = log(spark, *[("t", p, o, b"k", b"1") for p in (0, 1) for o in range(5, 10)], ("u", 0, 0, b"k", b"1"))
    assert rows(messages.watermarks(df)) == [("t", 0, 5, 10), ("t", 1, 5, 10), ("u", 0, 0, 1)]
    commits = messages.commit_positions(df.filter("topic = 't' AND `partition` = 0 AND offset < 8"), "g")
    assert rows(commits) == [("g", "t", 0, 8)]
    assert rows(messages.consumer_lag(messages.watermarks(df), commits)) == [("g", "t", 0, 8, 10, 2), ("g", "t", 1, 0, 10, 10)]
    ranges = spark.createDataFrame([("t", 0, 6, 8), ("t", 1, None, 6)], "topic string, partition int, from_offset long, to_offset long")
    assert rows(messages.offset_range(df, ranges), "partition", "offset") == [(0, 6), (0, 7), (1, 5)]
    positions = commits.drop("group_id")
    assert rows(messages.next_batch(df, positions, 2), "topic", "partition", "offset") == [
        ("t", 0, 8), ("t", 0, 9), ("t", 1, 5), ("t", 1, 6), ("u", 0, 0)]
    assert rows(messages.describe_topics(df)) == [("t", 2, 10), ("u", 1, 1)]


def test_compaction_and_retention(spark):
    df = log(spark, ("t", 0, 0, b"a", b"1"), ("t", 0, 1, b"a", b"2"), ("t", 0, 2, b"b", b"1"), ("t", 0, 3, b"b", None))
    assert rows(messages.compact(df), "key", "offset") == [(b"a", 1)]
    timed = df.withColumn("timestamp", F.expr("timestamp'2024-01-10' - make_dt_interval(offset)"))
    kept = messages.retain(timed, {"t": 2 * 86400000}, F.lit("2024-01-10").cast("timestamp"))
    assert rows(kept, "offset") == [(0,), (1,), (2,)]
    assert messages.retain(timed, {"x": 1}, F.lit("2024-01-10").cast("timestamp")).count() == 4


def test_topic_selection(spark):
    df = log(spark, *[(t, 0, 0, b"k", b"1") for t in ("raw-a", "raw-b", "x-raw-a")])
    assert rows(messages.select_topics(df, pattern="raw-.*"), "topic") == [("raw-a",), ("raw-b",)]
    assert rows(messages.select_topics(df, ["x-raw-a"]), "topic") == [("x-raw-a",)]
    with pytest.raises(ValueError):
        messages.select_topics(df)


def test_layout_for_sending_orders_each_partition(spark):
    df = log(spark, *[("t", o % 3, o, b"k", b"1") for o in range(300)])
    from pyspark.sql.functions import spark_partition_id
    laid = messages.ordered_for_write(df, 4).withColumn("task", spark_partition_id())
    seen = {}
    for r in laid.collect():
        key = (r["task"], r["partition"])
        assert seen.get(key, -1) < r["offset"]
        seen[key] = r["offset"]


def test_spread_layout_keeps_each_key_in_order(spark):
    from pyspark.sql.functions import spark_partition_id
    df = log(spark, *[("t", 0, o, b"k%d" % (o % 9), b"1") for o in range(300)])
    seen = {}
    for r in messages.ordered_for_write(df, 4, spread=8).withColumn("task", spark_partition_id()).collect():
        task, last = seen.get(bytes(r["key"]), (r["task"], -1))
        assert task == r["task"] and last < r["offset"]
        seen[bytes(r["key"])] = (task, r["offset"])
    assert len({t for t, _ in seen.values()}) > 1


def test_large_polls_are_cut_like_small_ones(spark):
    df = log(spark, *[("t", o % 2, o, b"k", b"1") for o in range(5000)])
    got = sorted((r["partition"], r["offset"]) for r in messages.next_batch(df, limit=1500).collect())
    assert got == [(p, o) for p in (0, 1) for o in range(p, 3000, 2)]


def test_wrapped_records_with_equal_data_stay_apart(spark):
    df = spark.createDataFrame([('{"a":1}', 0), ('{"a":1}', 1)], "data string, at int")
    wrap = lambda: [r.event_id for r in events.wrap_raw(df, F.col("data"), "s", F.lit("now"), position=[F.col("at")]).collect()]
    assert len(set(wrap())) == 2 and wrap() == wrap()
    with pytest.raises(ValueError):
        events.wrap_raw(df, F.col("data"), "s", F.lit("now"))


def test_kafka_options():
    assert kafka.offsets_json({("t", 0): 5, ("t", 1): -2}) == '{"t": {"0": 5, "1": -2}}'
    options = kafka.source_options("h:1", ["a", "b"], starting={("a", 0): 3}, max_per_trigger=500)
    assert options["subscribe"] == "a,b" and options["maxOffsetsPerTrigger"] == "500"
    assert kafka.source_options("h:1", pattern="raw-.*")["subscribePattern"] == "raw-.*"
    with pytest.raises(ValueError):
        kafka.source_options("h:1")


@pytest.mark.parametrize("limit", [1000, 1001, 2500])
def test_large_batches_equal_small_ones_by_rule(spark, limit):
    """Gaps, a partition with most of the log, one with less than a batch, one without a key, and positions."""
    log = spark.range(9000).select(
        F.lit("t").alias("topic"), F.when(F.col("id") < 7000, 0).when(F.col("id") < 8900, 1).when(F.col("id") < 8990, 2).alias("partition"),
        (F.col("id") * F.when(F.col("id") % 3 == 0, 7).otherwise(1) + F.col("id")).alias("offset"), F.col("id").alias("n"))
    positions = spark.createDataFrame([("t", 0, 5000)], "topic string, partition int, position long")
    for start in (None, positions):
        held = [r for r in log.collect() if start is None or r.partition != 0 or r.offset >= 5000]
        want = set()
        for part in (0, 1, 2, None):
            mine = sorted((r.offset, r.n) for r in held if r.partition == part)
            want |= {(part, o) for o, _ in mine[:limit]}
        got = messages.next_batch(log, start, limit).collect()
        assert {(r.partition, r.offset) for r in got} == want and all(
            sum(r.partition == p for r in got) == min(limit, sum(r.partition == p for r in held)) for p in (0, 1, 2, None))
