"""P11, P14, P15, P19, D8."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.codec import json_value, parse_json_value
from tidemark.functions.domains import normalise_domain
from tidemark.functions.times import epoch_seconds_to_text, time_auto
from tidemark.schemas import WINDOW_COUNT


def test_time_auto_detects_iso_and_millis(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:00:07.179Z",), ("2024-01-01 00:00:07.179",), ("1704067207179",),
         ("2024-01-01T02:00:07.179+02:00",), ("bad",), (None,)],
        "c string",
    )
    got = [r.t for r in df.select(time_auto("c").cast("timestamp_ntz").alias("t")).collect()]
    want = dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert got == [want, want, want, want, None, None]


def test_epoch_seconds_text(spark):
    df = spark.createDataFrame([(0,), (1704067210,)], "t bigint")
    got = [r[0] for r in df.select(epoch_seconds_to_text("t")).collect()]
    assert got == ["1970-01-01 00:00:00.000", "2024-01-01 00:00:10.000"]


def test_json_round_trip_keeps_types(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0, 10), 3)]
    df = spark.createDataFrame(rows, WINDOW_COUNT)
    text = df.select(json_value("*").cast("string").alias("v")).first().v
    assert '"ten_second_window":"2024-01-01 00:00:10.000"' in text
    back = df.select(json_value("*").alias("value")).select(parse_json_value("value", WINDOW_COUNT).alias("r"))
    assert back.select("r.*").collect() == df.collect()


def test_normalise_domain(spark):
    df = spark.createDataFrame([("en.wikipedia.org",), ("WWW.Commons.Wikimedia.org",), ("en.wikipedia",), (None,)], "d string")
    got = [r[0] for r in df.select(normalise_domain("d")).collect()]
    assert got == ["en.wikipedia", "commons.wikimedia", "en.wikipedia", None]


def test_kafka_topic_options():
    from tidemark.sources.topics import Topic

    t = Topic("edit-events", format="kafka", options={"kafka.bootstrap.servers": "k:9092"}, group_id="g1")
    assert t._kafka_options() == {
        "subscribe": "edit-events",
        "startingOffsets": "earliest",
        "kafka.group.id": "g1",
        "kafka.bootstrap.servers": "k:9092",
    }


def test_decode_topic_skip_drops_malformed_records(spark):
    from tidemark.sinks.segments import to_day_segments
    from tidemark.sinks.topics import to_text_frames
    from tidemark.sources.topics import Topic, decode_topic

    texts = [
        '{"domain": "a", "ten_second_window": "2024-01-01 00:00:10.000", "count_actions": 3}',
        "not json",
        None,
        '{"domain": "b", "ten_second_window": "1704067220000", "count_actions": 1}',
    ]
    frames = to_text_frames(spark.createDataFrame([(t,) for t in texts], "value string"), Topic("c"))
    rows = decode_topic(frames, WINDOW_COUNT, on_error="skip", with_metadata=True).collect()
    # b's time is epoch-ms text, not the declared type: null, the record stays
    assert [r.domain for r in rows] == ["a", "b"] and rows[0].kafka_timestamp is not None
    assert rows[1].ten_second_window is None and rows[1].count_actions == 1
    day = {r["domain"]: r["__time"] for r in to_day_segments(frames, on_error="skip").collect()}
    assert day["a"].replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 10)
    assert day["b"].replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 20)
