"""Day-segmented table fed from the counts topic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import time_auto
from tidemark.operators.pageviews import as_date
from tidemark.sinks.partitions import write_partitions
from tidemark.sources.topics import decode_topic

# The counts topic payload; the time column is kept as text and typed by
# detection (ISO text or epoch milliseconds), as the ingestion spec asks.
COUNT_PAYLOAD = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("ten_second_window", T.StringType()),
        T.StructField("count_actions", T.LongType()),
    ]
)


def to_day_segments(frames: DataFrame, on_error: str = "fail") -> DataFrame:
    """Counts-topic frames -> rows of the day table.  No rollup, times kept
    unrounded; ``segment_day`` is the partition column.  ``on_error``:
    ``"fail"`` or ``"skip"`` (malformed records dropped)."""
    rows = decode_topic(frames, COUNT_PAYLOAD, on_error=on_error, with_metadata=True)
    return rows.select(
        time_auto(F.col("ten_second_window")).alias("__time"),
        F.col("count_actions"),
        F.col("domain"),
        F.col("kafka_timestamp"),
    ).withColumn("segment_day", F.to_date("__time"))


def write_segments(rows: DataFrame, root: str, days: Iterable | None = None) -> None:
    """Batch load of whole days: each day present is replaced, and each of
    ``days``, the days the load answers for, even if it has no rows."""
    write_partitions(rows.hint("rebalance", "segment_day"), root, "parquet", "segment_day", answers_for=days)


def replace_time_chunk(rows: DataFrame, root: str, start, end, cluster_by: tuple[str, ...] = ("domain",)) -> None:
    """Replaces the day table's chunk ``start <= __time < end``, whole
    days: every day of it, also one that has no rows any more; days outside
    stay as they are.  A row outside the chunk fails the job before anything
    is replaced.  Rows are dealt and sorted by day and ``cluster_by``, so a
    file holds a narrow range of them and its statistics prune reads."""
    first, last = as_date(start), as_date(end)
    if first >= last:
        raise ValueError(f"an empty chunk: {first} to {last}")
    inside = F.coalesce((F.col("segment_day") >= F.lit(first)) & (F.col("segment_day") < F.lit(last)), F.lit(False))
    outside = F.raise_error(F.concat(F.lit(f"row outside the chunk {first} to {last}: "), F.coalesce(F.col("__time").cast("string"), F.lit("null"))))
    checked = rows.withColumn("segment_day", F.when(inside, F.col("segment_day")).otherwise(outside.cast("date")))
    order = ["segment_day", *cluster_by, "__time"]
    clustered = checked.repartitionByRange(*order).sortWithinPartitions(*order)
    days = [first + dt.timedelta(days=k) for k in range((last - first).days)]
    write_partitions(clustered, root, "parquet", "segment_day", answers_for=days)


def write_segments_stream(rows: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Continuous load: append-only file sink, exactly once by checkpoint."""
    return (
        rows.writeStream.format("parquet")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .partitionBy("segment_day")
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
