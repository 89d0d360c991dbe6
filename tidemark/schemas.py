"""Declared schemas (D10: no inference) and the fixed value tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Pageviews (batch side)
# ---------------------------------------------------------------------------

# One record of the raw layer: the pageviews service reply flattened.
RAW_PAGEVIEW = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("pageviews", T.LongType()),
    ]
)

# Raw layer as stored: the run date is the partition column of the path.
RAW_PAGEVIEW_PARTITIONED = T.StructType(
    RAW_PAGEVIEW.fields + [T.StructField("processing_date", T.DateType())]
)

# The service reply: date -> domain -> views.
PAGEVIEW_REPLY = T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType()))

# Trusted layer and the external table over it.
TRUSTED_PAGEVIEW = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("pageviews", T.LongType()),
        T.StructField("pageview_date", T.DateType()),
        T.StructField("processing_date", T.DateType()),
    ]
)

TRUSTED_TABLE_DDL = (
    "domain STRING, pageviews BIGINT, pageview_date DATE, processing_date DATE"
)

# ---------------------------------------------------------------------------
# Edit events (stream side)
# ---------------------------------------------------------------------------

CORRUPT_COLUMN = "_corrupt_record"

# Fields of a raw change event that the normaliser reads.
RAW_EDIT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("meta", T.StructType([T.StructField("domain", T.StringType())])),
        T.StructField("namespace", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("user", T.StringType()),
        T.StructField("bot", T.BooleanType()),
    ]
)

# The normalised edit event published to the events topic.  ``createTime``
# travels as text ``yyyy-MM-dd HH:mm:ss.SSS`` (UTC) and is typed on read.
EDIT_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("createTime", T.TimestampType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("user_type", T.StringType()),
    ]
)

# One row of the window-count stream.
WINDOW_COUNT = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("ten_second_window", T.TimestampType()),
        T.StructField("count_actions", T.LongType(), nullable=False),
    ]
)

# A topic record as a Kafka source presents it (D9); file-backed topics keep
# the same columns so the same code reads either.
TOPIC_FRAME = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Day-segmented table fed from the counts topic.  The record timestamp is
# stored as ``kafka_timestamp`` (epoch ms): a dotted column name would need
# quoting in every SQL statement.
DAY_SEGMENT = T.StructType(
    [
        T.StructField("__time", T.TimestampType()),
        T.StructField("count_actions", T.LongType()),
        T.StructField("domain", T.StringType()),
        T.StructField("kafka_timestamp", T.LongType()),
        T.StructField("segment_day", T.DateType()),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's for equal results.
# ---------------------------------------------------------------------------

# Namespace code -> label; any other code is labelled "unknown".
NAMESPACE_LABELS = {
    -2: "Media",
    -1: "Special",
    0: "main namespace",
    1: "Talk",
    2: "User",
    3: "User Talk",
    4: "Wikipedia",
    5: "Wikipedia Talk",
    6: "File",
    7: "File Talk",
    8: "MediaWiki",
    9: "MediaWiki Talk",
    10: "Template",
    11: "Template Talk",
    12: "Help",
    13: "Help Talk",
    14: "Category",
    15: "Category Talk",
    100: "Portal",
    101: "Portal Talk",
    108: "Book",
    109: "Book Talk",
    118: "Draft",
    119: "Draft Talk",
    446: "Education Program",
    447: "Education Program Talk",
    710: "TimedText",
    711: "TimedText Talk",
    828: "Module",
    829: "Module Talk",
    2300: "Gadget",
    2301: "Gadget Talk",
    2302: "Gadget definition",
    2303: "Gadget definition Talk",
}
UNKNOWN_NAMESPACE = "unknown"

# User type label by the event's bot flag.
USER_TYPE_BOT = "bot"
USER_TYPE_HUMAN = "human"

# The only event type that is normalised and published.
EDIT_TYPE = "edit"

# Event-stream record kind that carries change events.
MESSAGE_KIND = "message"

# Projects whose pageviews are collected.
PAGEVIEW_DOMAINS = (
    "meta.wikimedia",
    "io.wiktionary",
    "pl.wiktionary",
    "az.wikipedia",
    "en.wikisource",
    "fi.wikipedia",
    "ka.wikipedia",
    "th.wikipedia",
    "pl.wikipedia",
    "en.wiktionary",
    "vi.wikipedia",
    "azb.wikipedia",
    "incubator.wikimedia",
    "tr.wikipedia",
    "en.wikibooks",
    "sr.wikipedia",
    "el.wiktionary",
    "it.wikipedia",
    "hi.wikipedia",
    "nl.wikipedia",
    "eo.wikipedia",
    "az.wikiquote",
    "no.wikipedia",
    "rue.wikipedia",
    "es.wikipedia",
    "ko.wikipedia",
    "bn.wikipedia",
    "fr.wikipedia",
    "ja.wikipedia",
    "fr.wiktionary",
    "zh.wikipedia",
    "de.wikipedia",
    "ca.wikipedia",
    "he.wikipedia",
    "lv.wikipedia",
    "uk.wikisource",
    "fa.wikipedia",
    "ar.wikipedia",
    "bg.wikipedia",
    "ru.wikipedia",
    "uk.wikipedia",
    "id.wikipedia",
    "pt.wikipedia",
    "sk.wikipedia",
    "cs.wikipedia",
    "en.wikipedia",
    "sv.wikipedia",
    "commons.wikimedia",
)

# Trusted window is [ds - 7 days, ds).
TRUSTED_LOOKBACK_DAYS = 7

# Event-time text format (UTC, milliseconds), watermark delay
# and tumbling window size of the window-count stream.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
WATERMARK_DELAY = "5 seconds"
WINDOW_SIZE = "10 seconds"
