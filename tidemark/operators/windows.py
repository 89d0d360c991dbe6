"""Event-time tumbling window count.

One function serves the batch table and the stream: the caller decides
whether a watermark is attached (streams) or not (batch replays).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import to_utc_timestamp_type
from tidemark.schemas import WATERMARK_DELAY, WINDOW_SIZE


def with_event_time(
    df: DataFrame, time_col: str = "createTime", delay: str = WATERMARK_DELAY
) -> DataFrame:
    """Mark ``time_col`` as event time with a bounded out-of-orderness.

    Watermarks need TIMESTAMP (D1); NTZ input is read as UTC wall clock.
    """
    if dict(df.dtypes)[time_col] != "timestamp":
        df = df.withColumn(time_col, to_utc_timestamp_type(time_col))
    return df.withWatermark(time_col, delay)


def tumbling_count(
    df: DataFrame,
    key_col: str = "domain",
    time_col: str = "createTime",
    size: str = WINDOW_SIZE,
    window_col: str = "ten_second_window",
    count_col: str = "count_actions",
) -> DataFrame:
    """Count non-null ``key_col`` per (key, epoch-aligned window).

    The window is half-open ``[start, end)`` and labelled by its end (D2).
    A null key forms its own group and counts 0 (D3).  ``count`` is
    algebraic, so Spark combines map-side before the one shuffle on
    (key, window): a hot key costs one partial row per map task, not one
    row per event.
    """
    return (
        df.groupBy(F.col(key_col), F.window(F.col(time_col), size).alias("_w"))
        .agg(F.count(F.col(key_col)).alias(count_col))
        .select(
            F.col(key_col),
            F.col("_w.end").alias(window_col),
            F.col(count_col),
        )
    )
