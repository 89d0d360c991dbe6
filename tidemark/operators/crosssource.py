"""Join of stream results with batch pageviews (Q5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.domains import normalise_domain


def daily_event_counts(events: DataFrame, time_col: str = "createTime") -> DataFrame:
    """Edit events -> edits per (domain key, day of the edit), in one
    aggregation.  A ten-second window never crosses midnight, so this equals
    the roll-up of window counts."""
    return events.groupBy(normalise_domain("domain").alias("domain"), F.to_date(time_col).alias("day")).agg(
        F.count("domain").alias("edits")
    )


def daily_edits(window_counts: DataFrame, window_col: str = "ten_second_window", size_seconds: int = 10) -> DataFrame:
    """Window counts -> edits per (domain key, day of the window start)."""
    start = F.col(window_col) - F.make_dt_interval(secs=F.lit(size_seconds))
    return window_counts.groupBy(
        normalise_domain("domain").alias("domain"), F.to_date(start).alias("day")
    ).agg(F.sum("count_actions").alias("edits"))


def daily_pageviews(trusted: DataFrame) -> DataFrame:
    """Trusted rows -> pageviews per (domain key, day).  Runs overlap by
    design (a day is in seven runs), so the latest run's figure is taken."""
    return trusted.groupBy(
        normalise_domain("domain").alias("domain"), F.col("pageview_date").alias("day")
    ).agg(F.max_by("pageviews", "processing_date").alias("pageviews"))


def cross_source_daily(edits: DataFrame, pageviews: DataFrame) -> DataFrame:
    """Q5: for every (domain, day) that has edits or pageviews, its edit count
    (0 without edits), its pageviews (null without) and edits per pageview.
    Both sides are already one row per (domain, day), so the full join moves
    aggregates, never events."""
    joined = pageviews.join(edits, on=["domain", "day"], how="full")
    edit_count = F.coalesce(F.col("edits"), F.lit(0)).cast("bigint")
    return joined.select(
        "domain",
        "day",
        edit_count.alias("edits"),
        F.col("pageviews"),
        F.when(F.col("pageviews") > 0, edit_count / F.col("pageviews")).alias("edit_ratio"),
    )
