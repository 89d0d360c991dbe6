"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (no id subsets, no caps except G2, whose
limit is the feature).  Queries that write (layers, index, table, stream
sinks) do so under a fresh folder of the shared scratch area and return
the read-back DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import time_auto, to_ntz
from tidemark.operators import crosssource, limits, lookups, sketches
from tidemark.operators import events as edit_ops
from tidemark.operators import pageviews as pv
from tidemark.operators.windows import tumbling_count
from tidemark.plans import catalog, jobs
from tidemark.plans import driver_tables as dtab
from tidemark.schemas import (
    DAY_SEGMENT,
    EDIT_EVENT,
    NAMESPACE_LABELS,
    TRUSTED_PAGEVIEW,
    TRUSTED_TABLE_DDL,
    WINDOW_COUNT,
)
from tidemark.session import configure, scratch_path
from tidemark.sinks.index import write_index_batch
from tidemark.sinks.layers import write_raw
from tidemark.sinks.segments import to_day_segments, write_segments
from tidemark.sinks.topics import to_frames, write_topic
from tidemark.sources.index import read_index
from tidemark.sources.rawjson import read_raw, read_raw_run
from tidemark.sources.segments import read_segments
from tidemark.sources.tables import read_table, table_glob, table_path
from tidemark.sources.topics import Topic, decode_topic, read_topic
from tidemark.streaming import window_stream as ws
from tidemark.streaming.normaliser_stream import start_normaliser

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENTS_TOPIC = Topic("edit-events")
COUNTS_TOPIC = Topic("edit-window-counts")


#: State partitions of the registered stream replays, fixed by their start.
STATE_PARTITIONS = 16


def _events(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    configure(spark)
    return dtab.events(spark, sf_dir, cols)


def _window_input(spark: SparkSession, sf_dir: str, domain=None) -> DataFrame:
    ev = _events(spark, sf_dir, ["event_type", "ts"])
    key = F.col("event_type") if domain is None else domain
    return ev.select(key.alias("domain"), F.col("ts").alias("createTime"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dtab.daily_pageviews(_events(spark, sf_dir, ["event_type", "ts"]))


def _edit_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events topic frames: JSON value of the 7-field event; record time =
    the event's full-precision ``ts``."""
    edits = dtab.edit_events(_events(spark, sf_dir, EVENT_COLS), time_as_text=True,
                             with_record_time=True)
    return to_frames(edits, EVENTS_TOPIC, value_cols=[f.name for f in EDIT_EVENT.fields],
                     key_col="domain", timestamp_col="_record_ts")


def _through_topic(spark: SparkSession, frames: DataFrame, name: str) -> DataFrame:
    """Frames published to a topic of this run and read back from it."""
    topic = Topic(name, path=scratch_path(spark, name))
    write_topic(frames, topic)
    return read_topic(spark, topic)


def _normalised_edits(spark: SparkSession, sf_dir: str, with_broken: bool = True) -> DataFrame:
    raw = dtab.raw_change_text(_events(spark, sf_dir, EVENT_COLS), with_broken=with_broken)
    return edit_ops.normalise_edits(edit_ops.parse_raw_edits(raw, "value", on_error="skip"))


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run date since the start that the data have."""
    daily = _daily(spark, sf_dir)
    dates = dtab.run_dates(daily) or (dtab.RUN_DATE, dtab.RUN_DATE)
    return pv.explode_run_dates(daily.withColumnRenamed("day", "pageview_date"), *dates).select(
        "domain", "pageviews", "pageview_date", "processing_date"
    )


def _write_backfill(spark: SparkSession, sf_dir: str, root: str) -> None:
    daily = _daily(spark, sf_dir)
    dates = dtab.run_dates(daily) or (dtab.RUN_DATE, dtab.RUN_DATE)
    jobs.backfill_from_pageviews(spark, *dates, daily.withColumnRenamed("day", "pageview_date"), root)


# --------------------------------------------------------------------------
# Window count: T2, G1, P3, P18 (batch) and T1-T4 (stream)
# --------------------------------------------------------------------------

def q_tumbling_count(spark, sf_dir):
    return tumbling_count(_window_input(spark, sf_dir))


def q_tumbling_count_null_key(spark, sf_dir):
    return tumbling_count(_window_input(spark, sf_dir, F.nullif(F.col("event_type"), F.lit("error"))))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table replayed as a file stream."""
    configure(spark)
    return spark.readStream.schema(dtab.events(spark, sf_dir).schema).parquet(table_glob(sf_dir, "events"))


def _count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits = _event_stream(spark, sf_dir).select(
        F.col("event_type").alias("domain"), F.col("ts").alias("createTime")
    )
    return ws.window_counts(edits)


def q_stream_replay_closed(spark, sf_dir):
    """Windows the watermark has closed are written once to a Parquet sink
    and read back."""
    out = scratch_path(spark, "stream_replay_closed")
    with ws.state_partitions(spark, STATE_PARTITIONS):
        q = ws.start_counts_to_files(_count_stream(spark, sf_dir), f"{out}/table", f"{out}/checkpoint")
    ws.drain(q)
    return ws.to_output_times(spark.read.schema(WINDOW_COUNT).parquet(f"{out}/table"))


def q_stream_fanout_index(spark, sf_dir):
    """T6 + K3 + K4: one count stream into the counts topic and the index as
    two queries; the index is read back (S6)."""
    out = scratch_path(spark, "stream_fanout")
    counts_topic = Topic(COUNTS_TOPIC.name, path=f"{out}/counts")
    with ws.state_partitions(spark, STATE_PARTITIONS):
        to_topic, to_index = ws.start_fanout(_count_stream(spark, sf_dir), counts_topic, f"{out}/index",
                                             f"{out}/ckpt")
    ws.drain(to_topic)
    ws.drain(to_index)
    docs = read_index(spark, f"{out}/index")
    return ws.to_output_times(docs.select("domain", "ten_second_window", "count_actions"))


def q_stream_day_segments(spark, sf_dir):
    """T7 + K6: events -> counts topic -> day-segmented table, each hop a
    checkpointed stream; rows per day of the table."""
    out = scratch_path(spark, "stream_segments")
    counts_topic = Topic(COUNTS_TOPIC.name, path=f"{out}/counts")
    with ws.state_partitions(spark, STATE_PARTITIONS):
        q = ws.start_counts_to_topic(_count_stream(spark, sf_dir), counts_topic, f"{out}/ckpt/counts")
    ws.drain(q)
    ws.drain(ws.start_day_segments(spark, counts_topic, f"{out}/segments", f"{out}/ckpt/segments"))
    seg = spark.read.schema(DAY_SEGMENT).parquet(f"{out}/segments")
    return seg.groupBy("segment_day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("count_actions").alias("total_actions")
    )


def q_stream_edit_normalise(spark, sf_dir):
    """S8 + P8-P13 + K5 as a stream: raw text (with broken copies) ->
    normalised edits -> events topic, read back and decoded (S3)."""
    out = scratch_path(spark, "stream_normaliser")
    topic = Topic(EVENTS_TOPIC.name, path=f"{out}/edit-events")
    raw = dtab.raw_change_text(_event_stream(spark, sf_dir), with_broken=True)
    ws.drain(start_normaliser(raw, topic, f"{out}/ckpt"))
    decoded = decode_topic(read_topic(spark, topic), EDIT_EVENT)
    return decoded.withColumn("createTime", to_ntz("createTime"))


# --------------------------------------------------------------------------
# Topics: S3, S4, K3, K5, P14, P15
# --------------------------------------------------------------------------

def q_topic_json_parse(spark, sf_dir):
    parsed = decode_topic(_through_topic(spark, _edit_frames(spark, sf_dir), EVENTS_TOPIC.name), EDIT_EVENT)
    return parsed.withColumn("createTime", to_ntz("createTime"))


def q_topic_json_serialise(spark, sf_dir):
    counts = tumbling_count(_window_input(spark, sf_dir))
    frames = to_frames(counts, COUNTS_TOPIC, timestamp_col="ten_second_window")
    frames = _through_topic(spark, frames, COUNTS_TOPIC.name)
    return decode_topic(frames, WINDOW_COUNT).withColumn("ten_second_window", to_ntz("ten_second_window"))


def q_topic_metadata(spark, sf_dir):
    schema = T.StructType([EDIT_EVENT["id"], EDIT_EVENT["domain"], EDIT_EVENT["createTime"], EDIT_EVENT["user_name"]])
    frames = _through_topic(spark, _edit_frames(spark, sf_dir), EVENTS_TOPIC.name)
    out = decode_topic(frames, schema, with_metadata=True, record_columns=("topic", "key"))
    return out.withColumns({"createTime": to_ntz("createTime"), "kafka_key": F.col("kafka_key").cast("string")})


# --------------------------------------------------------------------------
# Edit-event normaliser: S8, P8-P13, P19
# --------------------------------------------------------------------------

def q_edit_parse_skip_bad(spark, sf_dir):
    raw = dtab.raw_change_text(_events(spark, sf_dir, EVENT_COLS), with_broken=True)
    parsed = edit_ops.parse_raw_edits(raw, "value", on_error="skip")
    return parsed.select("id", "type", F.col("meta.domain").alias("domain"), "namespace", "title",
                         "timestamp", "user", "bot")


def q_edit_normalise(spark, sf_dir):
    return _normalised_edits(spark, sf_dir)


def q_time_auto(spark, sf_dir):
    text = dtab.event_time_text(_events(spark, sf_dir, ["event_id", "event_type", "ts"]))
    return text.select("event_id", to_ntz(time_auto("time_text")).alias("parsed_time"))


def q_first_n_events(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "event_type", "ts", "user_id"]).select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("domain"),
        F.col("ts").alias("createTime"),
        F.col("user_id").cast("string").alias("user_name"),
    )
    return limits.first_n(ev, dtab.FIRST_N, "id")


# --------------------------------------------------------------------------
# Pageviews: S1, S2, S7, K1, K2, P1-P7, P16, P17, J1, J3
# --------------------------------------------------------------------------

def q_pageviews_flatten(spark, sf_dir):
    replies = dtab.pageview_replies(_daily(spark, sf_dir))
    return pv.flatten_replies(replies, "reply")


def q_domain_allowlist(spark, sf_dir):
    flat = dtab.flat_raw_records(_daily(spark, sf_dir))
    return pv.allowlist_filter(flat, dtab.ALLOWED_EVENT_DOMAINS, "domain")


def _write_raw_layer(spark, sf_dir) -> str:
    root = scratch_path(spark, "raw_layer")
    write_raw(dtab.raw_layer_records(_daily(spark, sf_dir)), root)
    return root


def q_raw_json_scan(spark, sf_dir):
    return read_raw(spark, _write_raw_layer(spark, sf_dir))


def q_partition_scan(spark, sf_dir):
    return read_raw_run(spark, _write_raw_layer(spark, sf_dir), dtab.RUN_DATE)


def _trusted_run(spark, sf_dir, raw_root=None) -> DataFrame:
    raw_root = raw_root or _write_raw_layer(spark, sf_dir)
    raw = read_raw_run(spark, raw_root, dtab.RUN_DATE).drop("processing_date")
    return pv.trusted_transform(raw, dtab.RUN_DATE)


def q_trusted_pageviews(spark, sf_dir):
    return _trusted_run(spark, sf_dir)


def q_trusted_write_readback(spark, sf_dir):
    """K2 + J1 + J4: the trusted job for the run date, run twice (a retry);
    dynamic overwrite keeps one copy.  The partition is read back."""
    raw_root = _write_raw_layer(spark, sf_dir)
    root = scratch_path(spark, "trusted_layer")
    for _ in range(2):
        jobs.trusted_job(spark, dtab.RUN_DATE, raw_root, root, mode="overwrite")
    return spark.read.schema(TRUSTED_PAGEVIEW).parquet(root)


def q_trusted_backfill(spark, sf_dir):
    return _backfill(spark, sf_dir)


# --------------------------------------------------------------------------
# Sinks read back: K4/S6, K6
# --------------------------------------------------------------------------

def q_index_scan(spark, sf_dir):
    target = scratch_path(spark, "index")
    write_index_batch(tumbling_count(_window_input(spark, sf_dir)), 0, target)
    return read_index(spark, target).select("domain", "ten_second_window", "count_actions").withColumn(
        "ten_second_window", to_ntz("ten_second_window")
    )


def q_day_segments(spark, sf_dir):
    counts = tumbling_count(_window_input(spark, sf_dir))
    frames = to_frames(counts, COUNTS_TOPIC, timestamp_col="ten_second_window")
    root = scratch_path(spark, "day_segments")
    write_segments(to_day_segments(frames), root)
    seg = spark.read.schema(DAY_SEGMENT).parquet(root)
    return seg.groupBy("segment_day").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("count_actions").alias("total_actions")
    )


def q_segments_time_range(spark, sf_dir):
    """K6 read side with time pruning: actions per domain for a
    week of ``__time`` from the day table; only those day folders are read."""
    counts = tumbling_count(_window_input(spark, sf_dir))
    root = scratch_path(spark, "day_table")
    write_segments(to_day_segments(to_frames(counts, COUNTS_TOPIC, timestamp_col="ten_second_window")), root)
    week = read_segments(spark, root, dtab.RANGE_START, dtab.RANGE_END)
    return week.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum("count_actions").alias("total_actions")
    )


# --------------------------------------------------------------------------
# Catalog and SQL: Q1-Q5
# --------------------------------------------------------------------------

def q_external_table_sql(spark, sf_dir):
    """J3 backfill job writes the trusted layer; Q1 external table over it,
    Q2 partition discovery, Q4 SQL."""
    base = scratch_path(spark, "external_table")
    _write_backfill(spark, sf_dir, f"{base}/trusted")
    db = "tidemark_" + base.rsplit("-", 1)[-1]
    catalog.create_database(spark, db, f"{base}/db")
    table = f"{db}.trusted_pageviews"
    catalog.create_trusted_table(spark, table, f"{base}/trusted")
    catalog.repair_table(spark, table)
    result = spark.sql(
        f"SELECT domain, processing_date, sum(pageviews) AS pageviews_7d, count(*) AS n_days "
        f"FROM {table} GROUP BY domain, processing_date"
    )
    # Keep the answer, not the run's catalog entries: the result is written
    # to the run's folder and the run's database is dropped (an external
    # table's files stay where they are).
    result.write.parquet(f"{base}/result")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.read.schema(result.schema).parquet(f"{base}/result")


def q_registry_list(spark, sf_dir):
    """Q3: named sources under catalogs, one SQL surface: the raw events and
    the trusted layer in ``lake``, the window index in ``search``, the
    day-segmented table in ``olap``; row count per source."""
    configure(spark)
    base = scratch_path(spark, "registry")
    _write_backfill(spark, sf_dir, f"{base}/trusted")
    write_index_batch(tumbling_count(_window_input(spark, sf_dir)), 0, f"{base}/index")
    # The day table is fed from the written index, not from a second count.
    counts = read_index(spark, f"{base}/index").drop("doc_id")
    write_segments(to_day_segments(to_frames(counts, COUNTS_TOPIC, timestamp_col="ten_second_window")),
                   f"{base}/segments")
    reg = catalog.SourceRegistry()
    run = "_" + base.rsplit("-", 1)[-1]  # catalogs of this run only
    reg.add(f"lake{run}", "events", "parquet", table_path(sf_dir, "events"))
    reg.add(f"lake{run}", "trusted_pageviews", "parquet", f"{base}/trusted", TRUSTED_TABLE_DDL, ("processing_date",))
    reg.add(f"search{run}", "edit_window_counts", "parquet", f"{base}/index")
    reg.add(f"olap{run}", "edit_window_counts", "parquet", f"{base}/segments")
    reg.register(spark, f"{base}/catalogs")
    listed = reg.listing(spark, counts=True).withColumn("catalog", F.regexp_replace("catalog", f"{run}$", ""))
    listed.write.parquet(f"{base}/listing")
    for name in ("lake", "search", "olap"):
        spark.sql(f"DROP DATABASE {name}{run} CASCADE")
    return spark.read.schema(listed.schema).parquet(f"{base}/listing")


def q_cross_source_daily(spark, sf_dir):
    """Q5: raw edit events against the backfilled pageviews, each counted once.
    The edits' day comes from the parsed record; the pageviews, one row per
    domain and day, are written once, for the run dates and the backfill."""
    base = scratch_path(spark, "cross_source")
    _daily(spark, sf_dir).write.parquet(f"{base}/daily")
    daily = spark.read.parquet(f"{base}/daily")
    raw = edit_ops.parse_raw_edits(dtab.raw_change_text(_events(spark, sf_dir, EVENT_COLS), with_broken=True), "value", on_error="skip")
    edits = edit_ops.edit_days(raw)
    dates = dtab.run_dates(daily) or (dtab.RUN_DATE, dtab.RUN_DATE)
    views = crosssource.daily_pageviews(pv.explode_run_dates(daily.withColumnRenamed("day", "pageview_date"), *dates))
    return crosssource.cross_source_daily(crosssource.daily_event_counts(edits, "day"), views)


# --------------------------------------------------------------------------
# Tier C: C1-C4
# --------------------------------------------------------------------------

def q_approx_users(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_type", "ts", "user_id"]).select(
        F.col("event_type").alias("domain"), F.to_date("ts").alias("day"), "user_id"
    )
    daily = sketches.hll_sketches(ev, ["domain", "day"], "user_id")
    merged = sketches.merge_hll(daily, ["domain"], "approx_users")
    exact = ev.groupBy("domain").agg(F.count_distinct("user_id").alias("users"))
    near = F.abs(F.col("approx_users") - F.col("users")) <= F.greatest(F.lit(2), 0.05 * F.col("users"))
    exact = exact.withColumnRenamed("domain", "_d")
    return merged.join(exact, F.col("domain").eqNullSafe(F.col("_d"))).select("domain", "users", near.alias("within_bound"))


def q_theta_overlap(spark, sf_dir):
    """C1 set operations: users active on both halves of the day, by event
    type: exact counts and whether the sketches' are within their bound."""
    ev = _events(spark, sf_dir, ["event_type", "ts", "user_id"]).select(
        F.col("event_type").alias("domain"), (F.hour("ts") < 12).alias("early"), "user_id"
    ).where("domain IS NOT NULL")
    halves = [sketches.theta_sketches(ev.where(F.col("early") == early), ["domain"], "user_id") for early in (True, False)]
    seen = ev.groupBy("domain", "user_id").agg(F.max("early").alias("am"), F.min("early").alias("pm"))
    exact = seen.groupBy("domain").agg(
        F.count_if(F.col("am") & ~F.col("pm")).alias("in_both"), F.count("user_id").alias("in_either")
    )
    joined = sketches.theta_overlap(*halves, "domain").select(
        "domain", F.col("in_both").alias("_both"), F.col("in_either").alias("_either")
    ).join(exact, "domain")
    bound = F.greatest(F.lit(2), 0.05 * F.col("in_either"))
    near = (F.abs(F.col("_both") - F.col("in_both")) <= bound) & (F.abs(F.col("_either") - F.col("in_either")) <= bound)
    return joined.select("domain", "in_both", "in_either", near.alias("within_bound"))


def q_approx_histogram(spark, sf_dir):
    """C2 histogram: rows per group, and whether the histogram's heights add
    up to them."""
    ev = _events(spark, sf_dir, ["event_type", "value"]).withColumnRenamed("event_type", "domain").where("value IS NOT NULL")
    histogram = sketches.approx_histogram(ev, ["domain"], "value")
    total = F.aggregate("histogram", F.lit(0.0), lambda a, b: a + b["y"].cast("double"))
    exact = ev.groupBy("domain").agg(F.count("*").alias("n_rows"))
    exact = exact.withColumnRenamed("domain", "_d")
    return histogram.join(exact, F.col("domain").eqNullSafe(F.col("_d"))).select(
        "domain", "n_rows", (F.abs(total - F.col("n_rows")) < 1e-6 * F.col("n_rows") + 1e-6).alias("heights_add_up")
    )


def q_approx_quantiles(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_type", "value"]).withColumnRenamed("event_type", "domain")
    found = sketches.approx_quantiles(ev, ["domain"], "value")
    # Ranks of the approximate quantiles, counted over the whole table.
    pairs = ev.where("value IS NOT NULL").join(
        lookups.bounded_broadcast(found.withColumnRenamed("domain", "_d")), F.col("domain").eqNullSafe(F.col("_d"))
    )
    names = [("p50", 0.5), ("p90", 0.9), ("p99", 0.99)]
    counted = pairs.groupBy("domain").agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col("value") < F.col(p)).alias(f"lt_{p}") for p, _ in names],
        *[F.count_if(F.col("value") <= F.col(p)).alias(f"le_{p}") for p, _ in names],
    )
    slack = 0.01 * F.col("n_rows") + 1
    within = [
        ((F.col(f"lt_{p}") - slack <= q * F.col("n_rows")) & (F.col(f"le_{p}") + slack >= q * F.col("n_rows"))) for p, q in names
    ]
    return counted.select("domain", "n_rows", (within[0] & within[1] & within[2]).alias("within_bound"))


def q_lookup_join(spark, sf_dir):
    configure(spark)
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = lookups.lookup_join(nation, region, nation["n_regionkey"] == region["r_regionkey"])
    out = lookups.lookup_join(customer, geo, customer["c_nationkey"] == geo["n_nationkey"])
    return out.select("c_custkey", "c_name", "n_name", "r_name")


def q_lookup_latest(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"])
    return lookups.latest_per_key(ev, "user_id", "value", "event_id")


def q_latest_from_topic(spark, sf_dir):
    """C4 from a topic of updates: the last value per user by record time,
    read back from a written topic."""
    out = scratch_path(spark, "lookup_topic")
    topic = Topic("user-values", path=out)
    ev = _events(spark, sf_dir, ["event_id", "ts", "user_id", "value"]).select(
        "user_id", "event_id", "value", F.timestamp_seconds("event_id").alias("_record_ts")
    )
    write_topic(to_frames(ev, topic, value_cols=["user_id", "value"], timestamp_col="_record_ts"), topic)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return lookups.latest_from_topic(read_topic(spark, topic), schema, "user_id", "value")


# --------------------------------------------------------------------------
# Reruns, replays and mixed input
# --------------------------------------------------------------------------

def q_edit_parse_mixed_types(spark, sf_dir):
    """S8 on records whose namespace is text for errors and whose time is
    fractional for signups: valid JSON all the same, so every record stays."""
    ev = _events(spark, sf_dir, EVENT_COLS)
    raw = dtab.raw_change_events(ev)
    text = F.to_json(F.struct(
        "id", "type", "meta",
        F.when(F.col("type") == "log", F.lit('"x"')).otherwise(F.col("namespace").cast("string")).alias("namespace"),
        "title", F.when(F.col("type") == "new", F.col("timestamp") + 0.5).otherwise(F.col("timestamp").cast("double")).alias("timestamp"),
        "user", "bot",
    ))
    parsed = edit_ops.parse_raw_edits(raw.select(text.alias("value")), "value", on_error="skip")
    return parsed.select("id", "type", F.col("meta.domain").alias("domain"), "timestamp")


def q_trusted_empty_rerun(spark, sf_dir):
    """The daily job for two run dates, then the second again with
    a service that reports nothing: its rows go, the first day's stay."""
    base = scratch_path(spark, "empty_rerun")
    replies = dtab.pageview_replies(_daily(spark, sf_dir))
    days = (dtab.RUN_DATE, dtab.RUN_DATE + dt.timedelta(days=1))
    for day in days:
        jobs.daily_job(spark, day, replies, f"{base}/raw", f"{base}/trusted", domains=None)
    jobs.daily_job(spark, days[1], spark.createDataFrame([("{}",)], "reply string"), f"{base}/raw", f"{base}/trusted", domains=None)
    return spark.read.schema(TRUSTED_PAGEVIEW).parquet(f"{base}/trusted")


def q_daily_job(spark, sf_dir):
    """Raw, then trusted, for one run date, from the service's replies."""
    base = scratch_path(spark, "daily_job")
    replies = dtab.pageview_replies(_daily(spark, sf_dir))
    jobs.daily_job(spark, dtab.RUN_DATE, replies, f"{base}/raw", f"{base}/trusted", domains=list(dtab.ALLOWED_EVENT_DOMAINS))
    return spark.read.schema(TRUSTED_PAGEVIEW).parquet(f"{base}/trusted")


def q_backfill_from_raw(spark, sf_dir):
    """J3 (a): every run date of the raw layer in one job."""
    base = scratch_path(spark, "backfill_raw")
    daily = _daily(spark, sf_dir)
    write_raw(dtab.raw_layer_records(daily), f"{base}/raw")
    dates = dtab.run_dates(daily) or (dtab.RUN_DATE, dtab.RUN_DATE)
    jobs.backfill_from_raw(spark, *dates, f"{base}/raw", f"{base}/trusted")
    return spark.read.schema(TRUSTED_PAGEVIEW).parquet(f"{base}/trusted")


def q_insert_run(spark, sf_dir):
    """INSERT INTO of two runs, then INSERT OVERWRITE of both, of which
    the second comes out empty: one copy of the first, nothing of the other."""
    base = scratch_path(spark, "insert_run")
    db = "tidemark_" + base.rsplit("-", 1)[-1]
    catalog.create_database(spark, db, f"{base}/db")
    table = f"{db}.trusted_pageviews"
    catalog.create_trusted_table(spark, table, f"{base}/trusted")
    daily = dtab.flat_raw_records(_daily(spark, sf_dir))
    runs = [dtab.RUN_DATE, dtab.RUN_DATE + dt.timedelta(days=1)]
    rows, later = (pv.trusted_transform(daily, run) for run in runs)
    catalog.insert_run(spark, table, rows.unionByName(later), overwrite=False)
    catalog.insert_run(spark, table, rows, overwrite=True, runs=runs)
    result = spark.table(table)
    result.write.parquet(f"{base}/result")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.read.schema(result.schema).parquet(f"{base}/result")


def q_raw_json_array_scan(spark, sf_dir):
    """S1 in the collector's own form: each file one JSON array over lines."""
    root = scratch_path(spark, "raw_arrays")
    record = F.to_json(F.struct("date", "domain", "pageviews"))
    records = dtab.raw_layer_records(_daily(spark, sf_dir))
    # About 1,000 records in an array, however many domains a day has.
    slices = records.groupBy("processing_date", "date").agg(F.ceil(F.count(F.lit(1)) / 1000).alias("_slices"))
    dealt = records.join(slices, ["processing_date", "date"]).withColumn("_slice", F.pmod(F.xxhash64("domain"), F.col("_slices")))
    files = dealt.groupBy("processing_date", "date", "_slice").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), ",\n"), F.lit("\n]")).alias("value")
    )
    # One row, and so one array, in each file.
    files.select("value", "processing_date").write.option("maxRecordsPerFile", 1).partitionBy("processing_date").text(root)
    return read_raw(spark, root, multiline=True)


def q_index_replay(spark, sf_dir):
    """K4: the same windows indexed by two writers with other batches: one
    document per id all the same."""
    target = scratch_path(spark, "index_replay")
    counts = tumbling_count(_window_input(spark, sf_dir))
    write_index_batch(counts, 0, target, load_id="first")
    write_index_batch(counts.where("count_actions > 1"), 0, target, load_id="second")
    write_index_batch(counts.where("count_actions <= 1"), 1, target, load_id="second")
    write_index_batch(counts.where("count_actions <= 1"), 1, target, load_id="second")
    return read_index(spark, target).select("domain", "ten_second_window", "count_actions").withColumn(
        "ten_second_window", to_ntz("ten_second_window")
    )


def q_stream_late_drop(spark, sf_dir):
    """T5 over two data batches: the later half of the days first, then the
    earlier half, whose windows the watermark has closed: all late."""
    base = scratch_path(spark, "late_drop")
    ev = _events(spark, sf_dir, ["event_type", "ts"])
    low, high = ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    if low is None:
        return spark.createDataFrame([], WINDOW_COUNT)
    middle = low + dt.timedelta(days=(high - low).days // 2)
    rows = ev.select(F.col("event_type").alias("domain"), F.col("ts").alias("createTime"))
    later = F.to_date("createTime") >= F.lit(middle)
    # Two folders, read as one stream each in turn by one checkpointed query.
    rows.where(later).write.parquet(f"{base}/in/k=0")
    with ws.state_partitions(spark, STATE_PARTITIONS):
        for k, part in enumerate((None, rows.where(~later))):
            if part is not None:
                part.write.parquet(f"{base}/in/k={k}")
            stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in/k=*")
            q = ws.start_counts_to_files(ws.window_counts(stream), f"{base}/table", f"{base}/checkpoint")
            ws.drain(q)
    return ws.to_output_times(spark.read.schema(WINDOW_COUNT).parquet(f"{base}/table"))


_QUERY_FUNCTIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tumbling_count": q_tumbling_count,
    "tumbling_count_null_key": q_tumbling_count_null_key,
    "stream_replay_closed": q_stream_replay_closed,
    "stream_fanout_index": q_stream_fanout_index,
    "stream_day_segments": q_stream_day_segments,
    "stream_edit_normalise": q_stream_edit_normalise,
    "topic_json_parse": q_topic_json_parse,
    "topic_json_serialise": q_topic_json_serialise,
    "topic_metadata": q_topic_metadata,
    "edit_parse_skip_bad": q_edit_parse_skip_bad,
    "edit_normalise": q_edit_normalise,
    "time_auto": q_time_auto,
    "first_n_events": q_first_n_events,
    "pageviews_flatten": q_pageviews_flatten,
    "domain_allowlist": q_domain_allowlist,
    "raw_json_scan": q_raw_json_scan,
    "partition_scan": q_partition_scan,
    "trusted_pageviews": q_trusted_pageviews,
    "trusted_write_readback": q_trusted_write_readback,
    "trusted_backfill": q_trusted_backfill,
    "index_scan": q_index_scan,
    "day_segments": q_day_segments,
    "segments_time_range": q_segments_time_range,
    "external_table_sql": q_external_table_sql,
    "registry_list": q_registry_list,
    "cross_source_daily": q_cross_source_daily,
    "approx_users": q_approx_users,
    "approx_quantiles": q_approx_quantiles,
    "lookup_join": q_lookup_join,
    "lookup_latest": q_lookup_latest,
    "latest_from_topic": q_latest_from_topic,
    "theta_overlap": q_theta_overlap,
    "approx_histogram": q_approx_histogram,
    "edit_parse_mixed_types": q_edit_parse_mixed_types,
    "trusted_empty_rerun": q_trusted_empty_rerun,
    "daily_job": q_daily_job,
    "backfill_from_raw": q_backfill_from_raw,
    "insert_run": q_insert_run,
    "raw_json_array_scan": q_raw_json_array_scan,
    "index_replay": q_index_replay,
    "stream_late_drop": q_stream_late_drop,
}

# Day columns of the registered results.  They are handed to the comparison
# as midnight TIMESTAMP values on both sides: DuckDB returns DATE as
# ``datetime64`` through pandas but as ``date`` through ``fetchall``, while
# timestamps come back as datetimes either way.  The library functions
# themselves keep DATE.
DAY_COLUMNS: dict[str, tuple[str, ...]] = {
    "raw_json_scan": ("processing_date",),
    "partition_scan": ("processing_date",),
    "trusted_pageviews": ("pageview_date", "processing_date"),
    "trusted_write_readback": ("pageview_date", "processing_date"),
    "trusted_backfill": ("pageview_date", "processing_date"),
    "day_segments": ("segment_day",),
    "stream_day_segments": ("segment_day",),
    "external_table_sql": ("processing_date",),
    "cross_source_daily": ("day",),
    "trusted_empty_rerun": ("pageview_date", "processing_date"),
    "daily_job": ("pageview_date", "processing_date"),
    "backfill_from_raw": ("pageview_date", "processing_date"),
    "insert_run": ("pageview_date", "processing_date"),
    "raw_json_array_scan": ("processing_date",),
}


def _days_as_timestamps(fn, cols):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _days_as_timestamps(fn, DAY_COLUMNS[name]) if name in DAY_COLUMNS else fn
    for name, fn in _QUERY_FUNCTIONS.items()
}


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NS = "(VALUES " + ", ".join(
    f"({code}, {_sql_str(label)})" for code, label in NAMESPACE_LABELS.items()
) + ") AS ns(code, label)"
_NS_CODE = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"
_USER_TYPE = f"CASE WHEN value >= {dtab.BOT_VALUE_THRESHOLD} THEN 'bot' ELSE 'human' END"
_RAW_KIND = "CASE event_type " + " ".join(
    f"WHEN {_sql_str(k)} THEN {_sql_str(v)}" for k, v in dtab.RAW_KIND_BY_EVENT_TYPE.items()
) + " ELSE 'edit' END"
_WINDOW_END = "time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND"
_TUMBLING = (
    f"SELECT event_type AS domain, {_WINDOW_END} AS ten_second_window, "
    f"count(event_type) AS count_actions FROM events GROUP BY ALL"
)
_CLOSED = (
    f"SELECT * FROM ({_TUMBLING}) WHERE ten_second_window <= "
    f"(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 SECOND FROM events)"
)
_DAILY = "SELECT CAST(ts AS DATE) AS day, event_type AS domain, count(*) AS pageviews FROM events GROUP BY ALL"
_RUN = dtab.RUN_DATE.isoformat()
_BACKFILL = (
    f"SELECT domain, pageviews, day AS pageview_date, CAST(day + CAST(k AS INTEGER) AS DATE) AS processing_date "
    f"FROM (SELECT *, unnest(range(1, 8)) AS k FROM ({_DAILY}))"
)
_RAW_LAYER = (
    f"SELECT strftime(day, '%Y-%m-%d') AS date, domain, pageviews, "
    f"CAST(day + CAST(k AS INTEGER) AS DATE) AS processing_date "
    f"FROM (SELECT *, unnest(range(0, {dtab.RAW_REPLY_DAYS})) AS k FROM ({_DAILY}))"
)
_TRUSTED = (
    f"SELECT domain, pageviews, day AS pageview_date, DATE '{_RUN}' AS processing_date FROM ({_DAILY}) "
    f"WHERE day >= DATE '{_RUN}' - INTERVAL 7 DAY AND day < DATE '{_RUN}'"
)
_ALLOWED = ", ".join(_sql_str(d) for d in dtab.ALLOWED_EVENT_DOMAINS)

_ORACLE_SQL: dict[str, str] = {
    "tumbling_count": _TUMBLING,
    "tumbling_count_null_key": (
        f"SELECT NULLIF(event_type, 'error') AS domain, {_WINDOW_END} AS ten_second_window, "
        f"count(NULLIF(event_type, 'error')) AS count_actions FROM events GROUP BY ALL"
    ),
    "stream_replay_closed": _CLOSED,
    "stream_fanout_index": _CLOSED,
    "stream_day_segments": (
        f"SELECT CAST(ten_second_window AS DATE) AS segment_day, count(*) AS n_rows, "
        f"CAST(sum(count_actions) AS BIGINT) AS total_actions FROM ({_CLOSED}) GROUP BY ALL"
    ),
    "stream_edit_normalise": (
        f"SELECT CAST(event_id AS VARCHAR) AS id, event_type || '.org' AS domain, "
        f"coalesce(ns.label, 'unknown') AS namespace, props AS title, date_trunc('second', ts) AS createTime, "
        f"CAST(user_id AS VARCHAR) AS user_name, {_USER_TYPE} AS user_type "
        f"FROM events LEFT JOIN {_NS} ON ns.code = {_NS_CODE} WHERE {_RAW_KIND} = 'edit'"
    ),
    "topic_json_parse": (
        f"SELECT CAST(event_id AS VARCHAR) AS id, event_type AS domain, coalesce(ns.label, 'unknown') AS namespace, "
        f"props AS title, date_trunc('millisecond', ts) AS createTime, CAST(user_id AS VARCHAR) AS user_name, "
        f"{_USER_TYPE} AS user_type FROM events LEFT JOIN {_NS} ON ns.code = {_NS_CODE}"
    ),
    "topic_json_serialise": _TUMBLING,
    "topic_metadata": (
        "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS domain, date_trunc('millisecond', ts) AS createTime, "
        "CAST(user_id AS VARCHAR) AS user_name, epoch_us(ts) // 1000 AS kafka_timestamp, "
        f"{_sql_str(EVENTS_TOPIC.name)} AS kafka_topic, event_type AS kafka_key FROM events"
    ),
    "edit_parse_skip_bad": (
        f"SELECT event_id AS id, {_RAW_KIND} AS type, event_type || '.org' AS domain, {_NS_CODE} AS namespace, "
        f"props AS title, epoch_us(ts) // 1000000 AS \"timestamp\", CAST(user_id AS VARCHAR) AS \"user\", "
        f"value >= {dtab.BOT_VALUE_THRESHOLD} AS bot FROM events"
    ),
    "edit_normalise": (
        f"SELECT event_id AS id, event_type || '.org' AS domain, coalesce(ns.label, 'unknown') AS namespace, "
        f"props AS title, strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000' AS createTime, "
        f"CAST(user_id AS VARCHAR) AS user_name, {_USER_TYPE} AS user_type "
        f"FROM events LEFT JOIN {_NS} ON ns.code = {_NS_CODE} WHERE {_RAW_KIND} = 'edit'"
    ),
    "time_auto": "SELECT event_id, date_trunc('millisecond', ts) AS parsed_time FROM events",
    "first_n_events": (
        f"SELECT event_id AS id, event_type AS domain, ts AS createTime, CAST(user_id AS VARCHAR) AS user_name "
        f"FROM events ORDER BY event_id LIMIT {dtab.FIRST_N}"
    ),
    "pageviews_flatten": f"SELECT strftime(day, '%Y-%m-%d') AS date, domain, pageviews FROM ({_DAILY}) WHERE domain IS NOT NULL",
    "domain_allowlist": (
        f"SELECT strftime(day, '%Y-%m-%d') AS date, domain, pageviews FROM ({_DAILY}) WHERE domain IN ({_ALLOWED})"
    ),
    "raw_json_scan": _RAW_LAYER,
    "partition_scan": f"SELECT * FROM ({_RAW_LAYER}) WHERE processing_date = DATE '{_RUN}'",
    "trusted_pageviews": _TRUSTED,
    "trusted_write_readback": _TRUSTED,
    "trusted_backfill": _BACKFILL,
    "index_scan": _TUMBLING,
    "day_segments": (
        f"SELECT CAST(ten_second_window AS DATE) AS segment_day, count(*) AS n_rows, "
        f"CAST(sum(count_actions) AS BIGINT) AS total_actions FROM ({_TUMBLING}) GROUP BY ALL"
    ),
    "segments_time_range": (
        f"SELECT domain, count(*) AS n_windows, CAST(sum(count_actions) AS BIGINT) AS total_actions "
        f"FROM ({_TUMBLING}) WHERE ten_second_window >= TIMESTAMP '{dtab.RANGE_START}' "
        f"AND ten_second_window < TIMESTAMP '{dtab.RANGE_END}' GROUP BY ALL"
    ),
    "external_table_sql": (
        f"SELECT domain, processing_date, CAST(sum(pageviews) AS BIGINT) AS pageviews_7d, count(*) AS n_days "
        f"FROM ({_BACKFILL}) GROUP BY ALL"
    ),
    "registry_list": " UNION ALL ".join(
        [
            "SELECT 'lake' AS catalog, 'events' AS table_name, count(*) AS n_rows FROM events",
            f"SELECT 'lake' AS catalog, 'trusted_pageviews' AS table_name, count(*) AS n_rows FROM ({_BACKFILL})",
            f"SELECT 'search' AS catalog, 'edit_window_counts' AS table_name, count(*) AS n_rows FROM ({_TUMBLING})",
            f"SELECT 'olap' AS catalog, 'edit_window_counts' AS table_name, count(*) AS n_rows FROM ({_TUMBLING})",
        ]
    ),
    "cross_source_daily": (
        f"WITH e AS (SELECT event_type AS domain, CAST(ts AS DATE) AS day, count(*) AS edits FROM events "
        f"WHERE {_RAW_KIND} = 'edit' GROUP BY ALL), "
        f"p AS ({_DAILY}) "
        f"SELECT coalesce(p.domain, e.domain) AS domain, coalesce(p.day, e.day) AS day, "
        f"coalesce(e.edits, 0) AS edits, p.pageviews AS pageviews, "
        f"CASE WHEN p.pageviews > 0 THEN CAST(coalesce(e.edits, 0) AS DOUBLE) / p.pageviews END AS edit_ratio "
        f"FROM p FULL JOIN e ON e.domain = p.domain AND e.day = p.day"
    ),
    "lookup_join": (
        "SELECT c_custkey, c_name, n_name, r_name FROM customer "
        "LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"
    ),
    "lookup_latest": "SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
    "latest_from_topic": "SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
    "approx_users": "SELECT event_type AS domain, count(DISTINCT user_id) AS users, true AS within_bound FROM events GROUP BY 1",
    "approx_quantiles": (
        "SELECT event_type AS domain, count(*) AS n_rows, true AS within_bound FROM events WHERE value IS NOT NULL GROUP BY 1"
    ),
    "approx_histogram": (
        "SELECT event_type AS domain, count(*) AS n_rows, true AS heights_add_up FROM events WHERE value IS NOT NULL GROUP BY 1"
    ),
    "theta_overlap": (
        "SELECT domain, count(*) FILTER (am AND pm) AS in_both, count(user_id) AS in_either, true AS within_bound FROM ("
        "SELECT event_type AS domain, user_id, bool_or(hour(ts) < 12) AS am, bool_or(hour(ts) >= 12) AS pm "
        "FROM events WHERE event_type IS NOT NULL GROUP BY ALL) GROUP BY domain"
    ),
    "edit_parse_mixed_types": (
        f"SELECT event_id AS id, {_RAW_KIND} AS type, event_type || '.org' AS domain, "
        f"epoch_us(ts) // 1000000 AS \"timestamp\" FROM events"
    ),
    "trusted_empty_rerun": _TRUSTED,
    "daily_job": f"SELECT * FROM ({_TRUSTED}) WHERE domain IN ({_ALLOWED})",
    "backfill_from_raw": _BACKFILL,
    "insert_run": _TRUSTED,
    "raw_json_array_scan": _RAW_LAYER,
    "index_replay": _TUMBLING,
    "stream_late_drop": (
        f"SELECT * FROM ({_CLOSED}) WHERE ten_second_window - INTERVAL 10 SECOND >= "
        f"(SELECT CAST(min(CAST(ts AS DATE)) + CAST((max(CAST(ts AS DATE)) - min(CAST(ts AS DATE))) // 2 AS INTEGER) AS DATE) FROM events)"
    ),
}


def _oracle_with_day_timestamps(name: str, sql: str) -> str:
    cols = DAY_COLUMNS.get(name)
    if not cols:
        return sql
    casts = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


ORACLE_SQL: dict[str, str] = {name: _oracle_with_day_timestamps(name, sql) for name, sql in _ORACLE_SQL.items()}
