"""Registered queries of stored sketches, chunk replacement, the bulk writer,
bounded publishing, catch-up, compaction and live lookups, with their oracles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import to_ntz
from tidemark.operators import lookups, sketches
from tidemark.operators.events import parse_raw_edits
from tidemark.operators.windows import tumbling_count
from tidemark.plans import driver_queries as dq
from tidemark.plans import driver_tables as dtab
from tidemark.plans import jobs
from tidemark.plans.ledger import RunLedger, RunsFailed, catch_up
from tidemark.schemas import DAY_SEGMENT, EDIT_EVENT, EDIT_TYPE, TRUSTED_PAGEVIEW, WINDOW_COUNT
from tidemark.session import scratch_path
from tidemark.sinks import bulk, compaction
from tidemark.sinks.index import with_doc_id
from tidemark.sinks.layers import write_raw
from tidemark.sinks.segments import replace_time_chunk, to_day_segments, write_segments
from tidemark.sinks.topics import to_frames
from tidemark.sources.topics import Topic, decode_topic, read_topic
from tidemark.streaming import window_stream as ws
from tidemark.streaming.cross_source_stream import cross_source_stream, start_cross_source
from tidemark.streaming.late_rows import read_counts, read_late, start_counts_and_late
from tidemark.streaming.live_lookup import LookupVersions, read_enriched, start_enriched
from tidemark.streaming.normaliser_stream import start_normaliser

#: Buckets of the fixed histogram: 20 of [0, 200).
LOWER, UPPER, BUCKETS = 0.0, 200.0, 20
#: A day of the replaced week that comes out empty.
EMPTIED = dt.date(2024, 1, 10)


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq._events(spark, sf_dir, ["event_type", "ts", "value"]).select(
        F.col("event_type").alias("domain"), F.to_date("ts").alias("day"), "value"
    )


def _segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tumbling_count(dq._window_input(spark, sf_dir))
    return to_day_segments(to_frames(counts, dq.COUNTS_TOPIC, timestamp_col="ten_second_window"))


def _per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("segment_day").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("count_actions").alias("total_actions"))


def q_kll_quantiles(spark, sf_dir):
    """A quantile sketch per domain and day, stored; merged to domains from
    the stored ones; the exact ranks of their quantiles within the bound."""
    base = scratch_path(spark, "kll")
    ev = _values(spark, sf_dir)
    sketches.kll_sketches(ev, ["domain", "day"], "value").write.parquet(f"{base}/daily")
    merged = sketches.merge_kll(spark.read.parquet(f"{base}/daily"), ["domain"])
    found = sketches.kll_quantiles(merged).withColumnRenamed("domain", "_d")
    probs = (0.5, 0.9, 0.99)
    names = [sketches.quantile_name(p) for p in probs]
    # One row per domain, measured before it is broadcast.
    ranked = ev.where("value IS NOT NULL").join(lookups.bounded_broadcast(found), F.col("domain").eqNullSafe(F.col("_d"))).groupBy("domain").agg(
        F.max("n_values").alias("n_values"), F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col("value") < F.col(p)).alias(f"lt_{p}") for p in names],
        *[F.count_if(F.col("value") <= F.col(p)).alias(f"le_{p}") for p in names],
    )
    slack = sketches.kll_rank_bound() * F.col("n_rows") + 1
    good = F.col("n_values") == F.col("n_rows")
    for p, name in zip(probs, names):
        good = good & (F.col(f"lt_{name}") - slack <= p * F.col("n_rows")) & (F.col(f"le_{name}") + slack >= p * F.col("n_rows"))
    return ranked.select("domain", "n_values", good.alias("within_bound"))


def q_fixed_histogram(spark, sf_dir):
    """Fixed-bucket histograms per domain and day, stored; merged to
    domains from the stored ones."""
    base = scratch_path(spark, "fixed_histogram")
    sketches.fixed_histograms(_values(spark, sf_dir), ["domain", "day"], "value", LOWER, UPPER, BUCKETS).write.parquet(f"{base}/daily")
    merged = sketches.merge_fixed(spark.read.parquet(f"{base}/daily"), ["domain"], BUCKETS)
    return merged.select("domain", "n_null", F.posexplode("counts").alias("bucket", "n_rows"))


def q_replace_time_chunk(spark, sf_dir):
    """A week of the day table is replaced by rows of some domains only,
    one of its days by none; the days around it stay."""
    root = scratch_path(spark, "time_chunk")
    rows = _segment_rows(spark, sf_dir)
    write_segments(rows, root)
    first, last = dtab.RANGE_START.date(), dtab.RANGE_END.date()
    inside = (F.col("segment_day") >= F.lit(first)) & (F.col("segment_day") < F.lit(last))
    chunk = rows.where(inside & (F.col("segment_day") != F.lit(EMPTIED)) & F.col("domain").isin(*dtab.ALLOWED_EVENT_DOMAINS))
    replace_time_chunk(chunk, root, first, last)
    return _per_day(spark.read.schema(DAY_SEGMENT).parquet(root))


def q_bulk_index(spark, sf_dir):
    """K4: the window counts through the bulk writer.  A first job fails in
    one task after others have sent; the job that runs again sends all: each
    document is there once."""
    target = scratch_path(spark, "bulk_index")
    docs = with_doc_id(tumbling_count(dq._window_input(spark, sf_dir)))
    bad = docs.limit(1).withColumn("doc_id", F.lit(None).cast("string"))
    try:
        bulk.write_bulk(docs.unionByName(bad), target)
    except PySparkException as e:
        if "without an id" not in str(e):
            raise
    bulk.write_bulk(docs, target)
    found = bulk.read_bulks(spark, target, WINDOW_COUNT)
    return found.groupBy("_id").agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in WINDOW_COUNT.names]).select(
        "domain", to_ntz("ten_second_window").alias("ten_second_window"), "count_actions", "copies"
    )


def q_stream_first_n(spark, sf_dir):
    """The normaliser stops at exactly N published events; started
    again on its checkpoint, it publishes no more."""
    out = scratch_path(spark, "stream_first_n")
    topic = Topic(dq.EVENTS_TOPIC.name, path=f"{out}/edit-events")
    for _ in range(2):
        raw = dtab.raw_change_text(dq._event_stream(spark, sf_dir), with_broken=True)
        ws.drain(start_normaliser(raw, topic, f"{out}/ckpt", max_events=dtab.FIRST_N))
    return decode_topic(read_topic(spark, topic), EDIT_EVENT).select("id", "domain", "user_name")


def q_backfill_resumed(spark, sf_dir):
    """Catch-up a week at a time with a ledger.  One week fails in all
    its tries, the others go on; called again, only that week runs."""
    base = scratch_path(spark, "backfill_resumed")
    daily = dq._daily(spark, sf_dir)
    write_raw(dtab.raw_layer_records(daily), f"{base}/raw")
    first, last = dtab.run_dates(daily) or (dtab.RUN_DATE, dtab.RUN_DATE)
    ledger = RunLedger(spark, f"{base}/ledger")
    done = []

    def work(start: dt.date, end: dt.date, broken: bool = False) -> None:
        if broken and start <= dtab.RUN_DATE <= end:
            raise OSError("the store is not there")
        jobs.backfill_from_raw(spark, start, end, f"{base}/raw", f"{base}/trusted")
        done.append(start)

    try:
        catch_up(ledger, first, last, lambda a, b: work(a, b, True), step_days=7)
    except RunsFailed:
        pass
    catch_up(ledger, first, last, work, step_days=7)
    states = spark.createDataFrame([(r.state, done.count(dt.date.fromisoformat(r.first))) for r in ledger.entries()], "state string, times int")
    if states.where("state <> 'done' OR times <> 1").count():
        raise AssertionError("a finished run was repeated or left out")
    return spark.read.schema(TRUSTED_PAGEVIEW).parquet(f"{base}/trusted")


def q_segments_compacted(spark, sf_dir):
    """K6: the day table loaded in two micro-batches that share their days,
    compacted after each, one of them replayed."""
    root = scratch_path(spark, "compacted")
    rows = _segment_rows(spark, sf_dir)
    parts = [rows.where(F.col("domain").isin(*dtab.ALLOWED_EVENT_DOMAINS)), rows.where(~F.coalesce(F.col("domain").isin(*dtab.ALLOWED_EVENT_DOMAINS), F.lit(False)))]
    for batch, part in enumerate(parts):
        compaction.add_batch(part, root, batch)
        compaction.add_batch(part, root, batch)
        compaction.compact(spark, root)
    return _per_day(compaction.read_compacted(spark, root))


def q_lookup_live(spark, sf_dir):
    """C4: a stream of events in two micro-batches, the lookup published anew
    between them: the earlier days see each user's least value, the later
    ones the greatest."""
    base = scratch_path(spark, "lookup_live")
    ev = dq._events(spark, sf_dir, ["event_id", "ts", "user_id", "value"])
    low, high = ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()), T.StructField("seen", T.DoubleType())])
    if low is None:
        return spark.createDataFrame([], schema)
    middle = F.lit(low + dt.timedelta(days=(high - low).days // 2))
    rows = ev.select("event_id", "user_id", (F.to_date("ts") >= middle).alias("later"))
    versions = LookupVersions(spark, f"{base}/lookup")
    for k, value in enumerate((F.min("value"), F.max("value"))):
        versions.publish(ev.groupBy("user_id").agg(value.alias("seen")))
        rows.where(F.col("later") == bool(k)).drop("later").write.parquet(f"{base}/in/k={k}")
        stream = spark.readStream.schema(rows.drop("later").schema).parquet(f"{base}/in/k=*")
        ws.drain(start_enriched(stream, f"{base}/lookup", "user_id", f"{base}/out", f"{base}/ckpt"))
    return read_enriched(spark, f"{base}/out", schema)


def q_stream_cross_source(spark, sf_dir):
    """Q5 as a stream: raw edit events and daily pageviews, both replayed as
    streams; the days that both have passed."""
    base = scratch_path(spark, "stream_cross_source")
    daily = dq._daily(spark, sf_dir).select("domain", (F.col("day").cast("timestamp") + F.make_dt_interval(secs=F.lit(86_399))).alias("reported"), "pageviews")
    daily.write.parquet(f"{base}/pageviews")
    raw = dtab.raw_change_text(dq._event_stream(spark, sf_dir), with_broken=True)
    parsed = parse_raw_edits(raw, "value", on_error="skip")
    edits = parsed.where(F.col("type") == F.lit(EDIT_TYPE)).select(F.col("meta.domain").alias("domain"), F.timestamp_seconds("timestamp").alias("createTime"))
    views = spark.readStream.schema(daily.schema).parquet(f"{base}/pageviews")
    with ws.state_partitions(spark, dq.STATE_PARTITIONS):
        ws.drain(start_cross_source(cross_source_stream(edits, views), f"{base}/table", f"{base}/ckpt"))
    return spark.read.schema("domain string, day date, edits long, pageviews long, edit_ratio double").parquet(f"{base}/table")


def q_stream_late_side(spark, sf_dir):
    """T5: the later half of the days first, then the earlier half, which is
    late.  Closed windows with their counts, and the late rows of the second
    sink, counted per window."""
    base = scratch_path(spark, "late_side")
    schema = "kind string, domain string, ten_second_window timestamp_ntz, n_rows long"
    ev = dq._events(spark, sf_dir, ["event_type", "ts"])
    low, high = ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    if low is None:
        return spark.createDataFrame([], schema)
    rows = ev.select(F.col("event_type").alias("domain"), F.col("ts").cast("timestamp").alias("createTime"))
    later = F.to_date("createTime") >= F.lit(low + dt.timedelta(days=(high - low).days // 2))
    for k, part in enumerate((rows.where(later), rows.where(~later))):
        part.write.parquet(f"{base}/in/k={k}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in/k=*")
        with ws.state_partitions(spark, 8):  # a Python worker each
            ws.drain(start_counts_and_late(stream, f"{base}/counts", f"{base}/late", f"{base}/ckpt"))
    counts = read_counts(spark, f"{base}/counts").select(F.lit("count").alias("kind"), "domain", "ten_second_window", F.col("count_actions").alias("n_rows"))
    late = tumbling_count(read_late(spark, f"{base}/late")).select(F.lit("late").alias("kind"), "domain", "ten_second_window", F.col("count_actions").alias("n_rows"))
    return counts.unionByName(late).withColumn("ten_second_window", to_ntz("ten_second_window"))


_QUERY_FUNCTIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "kll_quantiles": q_kll_quantiles,
    "fixed_histogram": q_fixed_histogram,
    "replace_time_chunk": q_replace_time_chunk,
    "bulk_index": q_bulk_index,
    "stream_first_n": q_stream_first_n,
    "backfill_resumed": q_backfill_resumed,
    "segments_compacted": q_segments_compacted,
    "lookup_live": q_lookup_live,
    "stream_cross_source": q_stream_cross_source,
    "stream_late_side": q_stream_late_side,
}

_DAYS = {
    "stream_cross_source": ("day",),
    "replace_time_chunk": ("segment_day",),
    "segments_compacted": ("segment_day",),
    "backfill_resumed": ("pageview_date", "processing_date"),
}

QUERIES = {name: dq._days_as_timestamps(fn, _DAYS[name]) if name in _DAYS else fn for name, fn in _QUERY_FUNCTIONS.items()}

_PER_DAY = "SELECT CAST(CAST(ten_second_window AS DATE) AS TIMESTAMP) AS segment_day, count(*) AS n_rows, CAST(sum(count_actions) AS BIGINT) AS total_actions"
_WIDTH = (UPPER - LOWER) / BUCKETS

_EDIT_TIMES = f"SELECT date_trunc('second', ts) AS t FROM events WHERE {dq._RAW_KIND} = 'edit'"

ORACLE_SQL: dict[str, str] = {
    "stream_late_side": (
        f"WITH d AS (SELECT CAST(min(CAST(ts AS DATE)) + CAST((max(CAST(ts AS DATE)) - min(CAST(ts AS DATE))) // 2 AS INTEGER) AS DATE) AS m FROM events) "
        f"SELECT CASE WHEN ten_second_window - INTERVAL 10 SECOND >= m THEN 'count' ELSE 'late' END AS kind, domain, ten_second_window, count_actions AS n_rows "
        f"FROM ({dq._TUMBLING}), d WHERE ten_second_window <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 5 SECOND FROM events)"
    ),
    "stream_cross_source": (
        f"SELECT * FROM ({dq.ORACLE_SQL['cross_source_daily']}) WHERE day + INTERVAL 1 DAY <= "
        f"(SELECT max(t) - INTERVAL 5 SECOND FROM ({_EDIT_TIMES}))"
    ),
    "kll_quantiles": (
        "SELECT event_type AS domain, count(*) AS n_values, true AS within_bound FROM events WHERE value IS NOT NULL GROUP BY 1"
    ),
    "fixed_histogram": (
        f"WITH e AS (SELECT event_type AS domain, value, CASE WHEN isnan(value) OR value >= {UPPER} THEN {BUCKETS + 1} WHEN value < {LOWER} THEN 0 "
        f"ELSE 1 + least(floor((value - {LOWER}) / {_WIDTH}), {BUCKETS - 1})::INT END AS bucket FROM events), "
        f"d AS (SELECT domain, count(*) FILTER (value IS NULL) AS n_null FROM e GROUP BY ALL) "
        f"SELECT d.domain, n_null, b.bucket::INT AS bucket, (SELECT count(*) FROM e WHERE e.domain IS NOT DISTINCT FROM d.domain AND e.value IS NOT NULL AND e.bucket = b.bucket) AS n_rows "
        f"FROM d, (SELECT unnest(range({BUCKETS + 2})) AS bucket) b"
    ),
    "replace_time_chunk": (
        f"{_PER_DAY} FROM ({dq._TUMBLING}) WHERE CAST(ten_second_window AS DATE) < DATE '{dtab.RANGE_START.date()}' "
        f"OR CAST(ten_second_window AS DATE) >= DATE '{dtab.RANGE_END.date()}' "
        f"OR (CAST(ten_second_window AS DATE) <> DATE '{EMPTIED}' AND domain IN ({dq._ALLOWED})) GROUP BY ALL"
    ),
    "bulk_index": f"SELECT *, 1::BIGINT AS copies FROM ({dq._TUMBLING})",
    "stream_first_n": (
        f"SELECT CAST(event_id AS VARCHAR) AS id, event_type || '.org' AS domain, CAST(user_id AS VARCHAR) AS user_name "
        f"FROM events WHERE {dq._RAW_KIND} = 'edit' ORDER BY event_id LIMIT {dtab.FIRST_N}"
    ),
    "backfill_resumed": f"SELECT * REPLACE (CAST(pageview_date AS TIMESTAMP) AS pageview_date, CAST(processing_date AS TIMESTAMP) AS processing_date) FROM ({dq._BACKFILL})",
    "segments_compacted": f"{_PER_DAY} FROM ({dq._TUMBLING}) GROUP BY ALL",
    "lookup_live": (
        "WITH d AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events) "
        "SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) >= a + CAST((b - a) // 2 AS INTEGER) "
        "THEN max(value) OVER (PARTITION BY user_id) ELSE min(value) OVER (PARTITION BY user_id) END AS seen FROM events, d"
    ),
}
