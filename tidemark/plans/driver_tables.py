"""How the driver's ``events`` table stands in for the edit stream and the
pageview service (FIXTURES.md F8).

``event_id`` -> id, ``event_type`` -> domain, ``ts`` -> event time,
``user_id`` -> user name; daily counts of events -> pageviews.  The raw
change-event fields that the table lacks are derived per row from its own
columns (rules below), so every derived input grows with the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import namespace_label
from tidemark.functions.times import unix_millis_of
from tidemark.operators.pageviews import as_date
from tidemark.schemas import EVENT_TIME_FORMAT, TRUSTED_LOOKBACK_DAYS, USER_TYPE_BOT, USER_TYPE_HUMAN
from tidemark.sources.tables import read_table

# Derivation rules for the fields ``events`` lacks.
# Raw change-event kind by event type; every other type is an edit.
RAW_KIND_BY_EVENT_TYPE = {"signup": "new", "error": "log"}
# Events whose value is at least this are made by bots.
BOT_VALUE_THRESHOLD = 100.0
# Stream host names carry the project suffix the batch side lacks.
HOST_SUFFIX = ".org"
# Event types whose times are sent as ISO text; the rest as epoch ms.
ISO_TIME_EVENT_TYPES = ("click", "signup", "view")

# Run parameters of the registered queries.
RUN_DATE = dt.date(2024, 1, 15)
# A raw reply for run ds holds the days ds-9 … ds (today still partial).
RAW_REPLY_DAYS = 10
ALLOWED_EVENT_DOMAINS = ("click", "purchase", "view")
# A week of the day table, [start, end), for the time-range read.
RANGE_START = dt.datetime(2024, 1, 8)
RANGE_END = dt.datetime(2024, 1, 15)
FIRST_N = 1000


def events(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return read_table(spark, sf_dir, "events", columns)


def _namespace_code():
    return F.get_json_object("props", "$.k").cast("int")


def _user_type():
    return F.when(F.col("value") >= BOT_VALUE_THRESHOLD, F.lit(USER_TYPE_BOT)).otherwise(
        F.lit(USER_TYPE_HUMAN)
    )


def _raw_kind():
    kind = F.lit("edit")
    for event_type, raw_kind in reversed(list(RAW_KIND_BY_EVENT_TYPE.items())):
        kind = F.when(F.col("event_type") == event_type, F.lit(raw_kind)).otherwise(kind)
    return kind


def edit_events(ev: DataFrame, time_as_text: bool = False, with_record_time: bool = False) -> DataFrame:
    """The normalised 7-field edit event (F5).  ``createTime`` stays the
    table's timestamp, or becomes the topic's text form.  With
    ``with_record_time`` the full-precision ``ts`` is kept as
    ``_record_ts`` (the producer's clock, used as the record timestamp)."""
    ts = F.date_format("ts", EVENT_TIME_FORMAT) if time_as_text else F.col("ts")
    extra = [F.col("ts").cast("timestamp").alias("_record_ts")] if with_record_time else []
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("domain"),
        namespace_label(_namespace_code()).alias("namespace"),
        F.col("props").alias("title"),
        ts.alias("createTime"),
        F.col("user_id").cast("string").alias("user_name"),
        _user_type().alias("user_type"),
        *extra,
    )


def raw_change_events(ev: DataFrame) -> DataFrame:
    """Raw change events as the public stream would send them."""
    return ev.select(
        F.col("event_id").alias("id"),
        _raw_kind().alias("type"),
        F.struct(F.concat(F.col("event_type"), F.lit(HOST_SUFFIX)).alias("domain")).alias("meta"),
        _namespace_code().alias("namespace"),
        F.col("props").alias("title"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("user_id").cast("string").alias("user"),
        (F.col("value") >= BOT_VALUE_THRESHOLD).alias("bot"),
    )


def raw_change_text(ev: DataFrame, with_broken: bool = True) -> DataFrame:
    """Raw records as text.  With ``with_broken`` every record also comes
    as an event-stream line (``event: {...}``), whole but not JSON, which
    must be skipped (S8).  One pass over the input, so it serves batch
    tables and streams alike."""
    text = F.to_json(F.struct(*[F.col(c) for c in raw_change_events(ev).columns]))
    raw = raw_change_events(ev).select(text.alias("value"))
    if not with_broken:
        return raw
    not_json = F.concat(F.lit("event: "), F.col("value"))
    return raw.select(F.explode(F.array(F.col("value"), not_json)).alias("value"))


def daily_pageviews(ev: DataFrame) -> DataFrame:
    """Pageviews per (day, domain) as the service reports them (F2)."""
    return ev.groupBy(
        F.to_date("ts").alias("day"), F.col("event_type").alias("domain")
    ).agg(F.count(F.lit(1)).alias("pageviews"))


def pageview_replies(daily: DataFrame, entries_per_reply: int = 1000) -> DataFrame:
    """Service replies (F1): date -> {domain: views}, about
    ``entries_per_reply`` domains per reply.

    Each day is cut into ``ceil(domains / entries_per_reply)`` hash slices,
    sized from a per-day count, so no reply grows with the number of
    domains or events.  The per-day table has one row per day.
    """
    slices = daily.groupBy("day").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(entries_per_reply))).alias("_slices")
    )
    keyed = daily.where("domain IS NOT NULL").join(slices, on="day").withColumn(
        "_slice", F.pmod(F.xxhash64("domain"), F.col("_slices"))
    )
    return (
        keyed.groupBy("day", "_slice")
        .agg(F.map_from_entries(F.collect_list(F.struct("domain", "pageviews"))).alias("_views"))
        .select(
            F.to_json(
                F.create_map(F.date_format("day", "yyyy-MM-dd"), F.col("_views"))
            ).alias("reply")
        )
    )


def raw_layer_records(daily: DataFrame, reply_days: int = RAW_REPLY_DAYS) -> DataFrame:
    """Raw records with their run date: day ``d`` is in the replies of runs
    ``d … d + reply_days - 1``."""
    return daily.select(
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        "domain",
        "pageviews",
        F.explode(F.sequence(F.col("day"), F.date_add("day", reply_days - 1))).alias("processing_date"),
    )


def flat_raw_records(daily: DataFrame) -> DataFrame:
    return daily.select(F.date_format("day", "yyyy-MM-dd").alias("date"), "domain", "pageviews")


def event_time_text(ev: DataFrame) -> DataFrame:
    """Times as a producer might send them: ISO text or epoch-ms text."""
    iso = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    millis = unix_millis_of("ts").cast("string")
    return ev.select(
        "event_id",
        F.when(F.col("event_type").isin(*ISO_TIME_EVENT_TYPES), iso).otherwise(millis).alias("time_text"),
    )


def run_dates(daily: DataFrame) -> tuple[dt.date, dt.date] | None:
    """First and last run date that a backfill since the start has: the day
    after the first day with pageviews, to the last that still sees one."""
    first, last = daily.agg(F.min("day"), F.max("day")).first()
    return None if first is None else (first + dt.timedelta(days=1), last + dt.timedelta(days=TRUSTED_LOOKBACK_DAYS))


def run_date() -> dt.date:
    return as_date(RUN_DATE)
