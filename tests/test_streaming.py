"""Stream replays from file-backed topics (FIXTURES F5)."""

import datetime as dt
import time

from pyspark.sql import functions as F

from tidemark.operators.windows import tumbling_count
from tidemark.schemas import EDIT_EVENT, EVENT_TIME_FORMAT, WINDOW_COUNT
from tidemark.sinks.index import with_doc_id
from tidemark.sinks.topics import to_frames, to_text_frames, write_topic
from tidemark.sources.index import read_index
from tidemark.sources.topics import Topic, decode_topic, read_topic
from tidemark.streaming import window_stream as ws


def _t(s):
    return dt.datetime.fromisoformat("2024-01-01 " + s)


def _publish(spark, topic, rows):
    """One step of the replay: one file with these (domain, createTime) rows."""
    df = spark.createDataFrame(
        [(str(i), d, "main namespace", "t", t, "u", "human") for i, (d, t) in enumerate(rows)],
        "id string, domain string, namespace string, title string, createTime string, user_name string, user_type string",
    )
    write_topic(to_frames(df, topic, timestamp_col=None).coalesce(1), topic)
    time.sleep(1.1)  # file streams order by modification time


def _closed(spark, path):
    return sorted(
        ((r.domain, r.ten_second_window.replace(tzinfo=None), r.count_actions)
         for r in ws.to_output_times(spark.read.parquet(path)).collect()),
        key=lambda t: (t[0] is None, t[0] or "", t[1]),
    )


def test_late_row_dropped_and_windows_closed_once(spark, scratch):
    """Two-run replay.  Spark filters late rows against the watermark of
    the previous micro-batch, so the late file is read in a second run,
    after the run that advanced the watermark to 00:00:11 ended."""
    topic = Topic("edit-events", path=f"{scratch}/topic")
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"
    _publish(spark, topic, [("a", "2024-01-01 00:00:01.000"), ("a", "2024-01-01 00:00:16.000")])
    ws.drain(ws.start_counts_to_files(ws.window_count_stream(spark, topic, 1), out, ckpt))
    assert _closed(spark, out) == [("a", _t("00:00:10"), 1)]
    _publish(spark, topic, [("a", "2024-01-01 00:00:02.000"), ("a", "2024-01-01 00:00:12.000"),
                            ("a", "2024-01-01 00:00:40.000")])
    q = ws.start_counts_to_files(ws.window_count_stream(spark, topic, 1), out, ckpt)
    ws.drain(q)
    # the closed window is unchanged, the late row is counted as dropped,
    # the window ending 00:00:40 + 10 s stays open
    assert _closed(spark, out) == [("a", _t("00:00:10"), 1), ("a", _t("00:00:20"), 2)]
    assert ws.dropped_by_watermark(q) == 1


def test_restart_from_checkpoint_no_duplicates(spark, scratch):
    topic = Topic("edit-events", path=f"{scratch}/topic")
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"
    _publish(spark, topic, [("a", "2024-01-01 00:00:01.000"), ("a", "2024-01-01 00:00:16.000")])
    ws.drain(ws.start_counts_to_files(ws.window_count_stream(spark, topic, 1), out, ckpt))
    first = _closed(spark, out)
    assert first == [("a", _t("00:00:10"), 1)]
    _publish(spark, topic, [("a", "2024-01-01 00:00:12.000"), ("a", "2024-01-01 00:00:40.000")])
    ws.drain(ws.start_counts_to_files(ws.window_count_stream(spark, topic, 1), out, ckpt))
    assert _closed(spark, out) == [("a", _t("00:00:10"), 1), ("a", _t("00:00:20"), 2)]


def _publish_events_by_day(spark, sf_dir, topic, days):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    edits = ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("domain"),
        F.lit("main namespace").alias("namespace"),
        F.col("props").alias("title"),
        F.date_format("ts", EVENT_TIME_FORMAT).alias("createTime"),
        F.col("user_id").cast("string").alias("user_name"),
        F.lit("human").alias("user_type"),
        F.to_date("ts").alias("_day"),
    )
    for lo, hi in days:
        part = edits.where((F.col("_day") >= F.lit(lo)) & (F.col("_day") < F.lit(hi))).drop("_day")
        write_topic(to_frames(part, topic, timestamp_col=None).coalesce(1), topic)
        time.sleep(1.1)
    return edits


def test_stream_equals_batch_on_closed_windows(spark, scratch):
    topic = Topic("edit-events", path=f"{scratch}/topic")
    d = dt.date(2024, 1, 1)
    steps = [(d + dt.timedelta(days=i), d + dt.timedelta(days=i + 8)) for i in range(0, 32, 8)]
    _publish_events_by_day(spark, "/root/testdata/sf0.001", topic, steps)
    q = ws.start_counts_to_files(ws.window_count_stream(spark, topic, max_per_trigger=1),
                                 f"{scratch}/out", f"{scratch}/ckpt")
    ws.drain(q)
    assert ws.dropped_by_watermark(q) == 0
    batch_events = decode_topic(read_topic(spark, topic), EDIT_EVENT)
    batch = tumbling_count(batch_events)
    watermark = batch_events.agg(F.max("createTime")).first()[0] - dt.timedelta(seconds=5)
    want = sorted(
        (r.domain, r.ten_second_window.replace(tzinfo=None), r.count_actions)
        for r in ws.to_output_times(batch.where(F.col("ten_second_window") <= F.lit(watermark))).collect()
    )
    got = _closed(spark, f"{scratch}/out")
    assert got == want
    # property: closed counts add up to the events before the last closed end
    epoch = dt.datetime(1970, 1, 1, tzinfo=watermark.tzinfo)
    last_end = epoch + dt.timedelta(seconds=(watermark - epoch).total_seconds() // 10 * 10)
    assert sum(c for _, _, c in got) == batch_events.where(F.col("createTime") < F.lit(last_end)).count()


def test_fanout_and_multi_hop(spark, scratch):
    """One query into a topic and an index; T7: topic -> day table."""
    events = Topic("edit-events", path=f"{scratch}/events")
    counts = Topic("edit-window-counts", path=f"{scratch}/counts")
    d = dt.date(2024, 1, 1)
    _publish_events_by_day(spark, "/root/testdata/sf0.001", events,
                           [(d, d + dt.timedelta(days=15)), (d + dt.timedelta(days=15), d + dt.timedelta(days=31))])
    stream = ws.window_count_stream(spark, events, max_per_trigger=1)
    to_topic, to_index = ws.start_fanout(stream, counts, f"{scratch}/index", f"{scratch}/ckpt")
    ws.drain(to_topic)
    ws.drain(to_index)
    topic_rows = decode_topic(read_topic(spark, counts), WINDOW_COUNT)
    index_rows = read_index(spark, f"{scratch}/index")
    n = topic_rows.count()
    assert n > 0 and index_rows.count() == n
    assert index_rows.select("doc_id").distinct().count() == n
    seg = ws.start_day_segments(spark, counts, f"{scratch}/segments", f"{scratch}/ckpt/segments")
    ws.drain(seg)
    table = spark.read.parquet(f"{scratch}/segments")
    assert table.count() == n
    assert table.agg(F.sum("count_actions")).first()[0] == topic_rows.agg(F.sum("count_actions")).first()[0]
    assert table.where(F.to_date("__time") != F.col("segment_day")).count() == 0
    assert set(table.columns) == {"__time", "count_actions", "domain", "kafka_timestamp", "segment_day"}


def test_index_doc_id_is_deterministic(spark):
    rows = [("a", _t("00:00:10"), 1), ("a", _t("00:00:20"), 2), (None, _t("00:00:10"), 0), ("", _t("00:00:10"), 4)]
    df = spark.createDataFrame(rows, "domain string, ten_second_window timestamp, count_actions bigint")
    ids1 = [r.doc_id for r in with_doc_id(df).collect()]
    ids2 = [r.doc_id for r in with_doc_id(df).collect()]
    assert ids1 == ids2 and len(set(ids1)) == 4


def test_stream_jobs_command_line(spark, scratch):
    """The three stream jobs chained through file topics, as run by hand."""
    from tidemark.streaming import jobs as stream_jobs

    raw = Topic("edit-raw", path=f"{scratch}/raw")
    texts = [
        '{"id": 1, "type": "edit", "meta": {"domain": "en.wikipedia.org"}, "namespace": 0, "title": "t",'
        ' "timestamp": 1704067201, "user": "u", "bot": false}',
        "not json",
        '{"id": 2, "type": "log", "meta": {"domain": "en.wikipedia.org"}, "namespace": 0, "title": "t",'
        ' "timestamp": 1704067202, "user": "u", "bot": false}',
        '{"id": 3, "type": "edit", "meta": {"domain": "en.wikipedia.org"}, "namespace": 0, "title": "t",'
        ' "timestamp": 1704067260, "user": "u", "bot": true}',
    ]
    texts_df = spark.createDataFrame([(t,) for t in texts], "value string")
    write_topic(to_text_frames(texts_df, raw).coalesce(1), raw)
    common = ["--trigger", "available-now"]
    for argv in (
        ["normalise", "--raw", f"{scratch}/raw", "--events", f"{scratch}/events", "--checkpoint", f"{scratch}/c1"],
        ["counts", "--events", f"{scratch}/events", "--counts", f"{scratch}/counts", "--index", f"{scratch}/index",
         "--checkpoint", f"{scratch}/c2"],
        ["segments", "--counts", f"{scratch}/counts", "--table", f"{scratch}/table", "--checkpoint", f"{scratch}/c3"],
    ):
        for q in stream_jobs.run(argv + common, spark=spark):
            ws.drain(q)
    events = decode_topic(read_topic(spark, Topic("edit-events", path=f"{scratch}/events")), EDIT_EVENT)
    assert sorted(r.id for r in events.collect()) == ["1", "3"]
    table = spark.read.parquet(f"{scratch}/table").collect()
    assert [(r.domain, r.count_actions) for r in table] == [("en.wikipedia.org", 1)]
    assert read_index(spark, f"{scratch}/index").count() == 1


def test_stream_null_domain_and_window_boundary(spark, scratch):
    """F5 'other' file: the null domain forms its own group with count 0;
    an event at 00:00:10.000 belongs to the window ending 00:00:20."""
    topic = Topic("edit-events", path=f"{scratch}/topic")
    _publish(spark, topic, [("a", "2024-01-01 00:00:09.500"), (None, "2024-01-01 00:00:09.500"),
                            ("b", "2024-01-01 00:00:10.000"), ("a", "2024-01-01 00:00:40.000")])
    q = ws.start_counts_to_files(ws.window_count_stream(spark, topic, 1), f"{scratch}/out", f"{scratch}/ckpt")
    ws.drain(q)
    assert _closed(spark, f"{scratch}/out") == [("a", _t("00:00:10"), 1), ("b", _t("00:00:20"), 1), (None, _t("00:00:10"), 0)]


def test_stop_after_n_published_events(spark, scratch):
    """G2 in stream form: the normaliser stops once N events are published
    (batch granular; one file per micro-batch here)."""
    from tidemark.streaming.normaliser_stream import raw_topic_stream, start_normaliser

    raw = Topic("edit-raw", path=f"{scratch}/raw")
    for i in range(8):
        texts = [f'{{"id": {10 * i + j}, "type": "edit", "meta": {{"domain": "d"}}, "namespace": 0, '
                 f'"title": "t", "timestamp": {1704067200 + 10 * i + j}, "user": "u", "bot": false}}'
                 for j in range(5)]
        write_topic(to_text_frames(spark.createDataFrame([(t,) for t in texts], "value string"), raw).coalesce(1), raw)
        time.sleep(1.1)
    events = Topic("edit-events", path=f"{scratch}/events")
    q = start_normaliser(raw_topic_stream(spark, raw, max_per_trigger=1), events, f"{scratch}/ckpt",
                         trigger={"processingTime": "1 second"})
    written = ws.stop_after(q, 8, poll_s=0.5, timeout_s=120)
    assert 8 <= written < 40  # stopped well before the 40 available events
    assert decode_topic(read_topic(spark, events), EDIT_EVENT).count() == written


def test_day_table_time_filter_prunes_days(spark, scratch):
    """A __time range reads only the matching segment_day folders."""
    from tidemark.sinks.segments import to_day_segments, write_segments
    from tidemark.sources.segments import read_segments

    from plans import plan_text

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    counts = tumbling_count(ev.select(F.col("event_type").alias("domain"), F.col("ts").alias("createTime")))
    write_segments(to_day_segments(to_frames(counts, Topic("c"), timestamp_col="ten_second_window")), f"{scratch}/day")
    got = read_segments(spark, f"{scratch}/day", "2024-01-05 12:00:00", "2024-01-07")
    plan = plan_text(got, "simple")
    assert "PartitionFilters: [isnotnull(segment_day" in plan and "2024-01-05" in plan
    want = counts.where((F.col("ten_second_window") >= F.lit(dt.datetime(2024, 1, 5, 12)))
                        & (F.col("ten_second_window") < F.lit(dt.datetime(2024, 1, 7)))).count()
    assert got.count() == want > 0


def test_fanout_as_one_query(spark, scratch):
    """T6 with one stateful query writing both sinks per micro-batch."""
    events = Topic("edit-events", path=f"{scratch}/events")
    counts = Topic("edit-window-counts", path=f"{scratch}/counts")
    d = dt.date(2024, 1, 1)
    _publish_events_by_day(spark, "/root/testdata/sf0.001", events,
                           [(d, d + dt.timedelta(days=15)), (d + dt.timedelta(days=15), d + dt.timedelta(days=31))])
    q = ws.start_fanout_one_query(ws.window_count_stream(spark, events, max_per_trigger=1), counts,
                                  f"{scratch}/index", f"{scratch}/ckpt")
    ws.drain(q)
    topic_rows = decode_topic(read_topic(spark, counts), WINDOW_COUNT)
    index_rows = read_index(spark, f"{scratch}/index").drop("doc_id", "batch_id")
    assert topic_rows.count() > 0
    assert sorted(map(tuple, topic_rows.collect())) == sorted(map(tuple, index_rows.select(*topic_rows.columns).collect()))


def test_max_events_only_for_the_normaliser(spark, scratch):
    import pytest

    from tidemark.streaming import jobs as stream_jobs

    with pytest.raises(SystemExit):
        stream_jobs.run(["counts", "--events", f"{scratch}/e", "--counts", f"{scratch}/c",
                         "--checkpoint", f"{scratch}/k", "--max-events", "5"], spark=spark)
