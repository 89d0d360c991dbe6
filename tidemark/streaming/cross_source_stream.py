"""Edits against pageviews as a stream (Q5): a full outer join of two daily
counts, each day written once, when both sources have passed it.

Both sides are counted per (domain, day window) first, so the join's state
holds one row per domain and open day and side, not events.  Both carry a
watermark; the query's is the earlier of the two, so a day waits for the slower
source, and a day that only one side knows comes out with the other side empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.domains import normalise_domain
from tidemark.operators.windows import with_event_time
from tidemark.schemas import WATERMARK_DELAY


def cross_source_stream(edits: DataFrame, pageviews: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """``edits`` (domain, createTime) and ``pageviews`` (domain, reported,
    pageviews) -> domain, day, edits, pageviews, edit_ratio.  ``reported`` is
    the time of a day's figure, a time of that day; of several figures for one
    day the largest counts, as they only grow."""
    day = F.window("_at", "1 day").alias("window")
    counted = (
        with_event_time(edits.withColumnRenamed("createTime", "_at"), "_at", delay)
        .groupBy(normalise_domain("domain").alias("domain"), day).agg(F.count("domain").alias("edits"))
    )
    views = (
        with_event_time(pageviews.withColumnRenamed("reported", "_at"), "_at", delay)
        .groupBy(normalise_domain("domain").alias("domain"), day).agg(F.max("pageviews").alias("pageviews"))
    )
    edit_count = F.coalesce(F.col("edits"), F.lit(0)).cast("bigint")
    return counted.join(views, ["domain", "window"], "fullOuter").select(
        "domain", F.to_date("window.start").alias("day"), edit_count.alias("edits"), "pageviews",
        F.when(F.col("pageviews") > 0, edit_count / F.col("pageviews")).alias("edit_ratio"),
    )


def start_cross_source(joined: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Closed days as a Parquet table, exactly once."""
    return (
        joined.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(**(trigger or {"availableNow": True})).start()
    )
