"""The windowed-count stream.

events topic --decode--> watermark 5 s --> 10 s tumbling count per domain
  --> counts topic (K3) and/or index (K4)   [two queries: T6]
counts topic --> day-segmented table (K6)   [multi-hop: T7]

Each query has its own checkpoint under the shared scratch area; file sinks
are exactly once, the index sink is idempotent by document id.  Rows reach
the sinks in append mode, i.e. once, when the watermark passes the window
end (T4); rows for windows already closed are dropped (T5) and counted in
``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.windows import tumbling_count, with_event_time
from tidemark.schemas import EDIT_EVENT, WATERMARK_DELAY, WINDOW_SIZE
from tidemark.sinks.index import index_writer
from tidemark.sinks.segments import to_day_segments, write_segments_stream
from tidemark.sinks.topics import to_frames, write_topic, write_topic_stream
from tidemark.sources.topics import Topic, decode_topic, read_topic

AVAILABLE_NOW = {"availableNow": True}


@contextmanager
def state_partitions(spark: SparkSession, n: int):
    """Start stateful queries with ``n`` state partitions.  A query fixes this
    number from ``spark.sql.shuffle.partitions`` when it starts and keeps it
    in its checkpoint; the session's own value is restored afterwards."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield n
    finally:
        spark.conf.set(key, old)


def window_counts(events: DataFrame, delay: str = WATERMARK_DELAY, size: str = WINDOW_SIZE) -> DataFrame:
    """Edit events (batch or stream) -> window counts with a watermark."""
    return tumbling_count(with_event_time(events, "createTime", delay), size=size)


def window_count_stream(
    spark: SparkSession,
    source: Topic,
    max_per_trigger: int | None = None,
    on_error: str = "fail",
    min_partitions: int | None = None,
) -> DataFrame:
    frames = read_topic(spark, source, streaming=True, max_per_trigger=max_per_trigger,
                        min_partitions=min_partitions)
    return window_counts(decode_topic(frames, EDIT_EVENT, on_error=on_error))


def start_counts_to_topic(counts: DataFrame, sink: Topic, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """K3: counts as JSON frames; the record time is the write time."""
    frames = to_frames(counts, sink)
    return write_topic_stream(frames, sink, checkpoint, trigger or AVAILABLE_NOW)


def start_counts_to_index(counts: DataFrame, target: str, checkpoint: str, trigger: dict | None = None,
                          format: str = "parquet", options: dict | None = None) -> StreamingQuery:
    """K4: counts to the index through ``foreachBatch``."""
    return (
        counts.writeStream.foreachBatch(index_writer(target, format, options))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_counts_to_files(counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Counts as a Parquet table (exactly once)."""
    return (
        counts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_fanout(counts: DataFrame, counts_topic: Topic, index_target: str, checkpoint_root: str,
                 trigger: dict | None = None):
    """The same count query into two sinks, as two independent queries
    with their own checkpoints (one failing does not stop the other).
    ``counts`` is a streaming DataFrame; each ``start`` runs it anew."""
    to_topic = start_counts_to_topic(counts, counts_topic, f"{checkpoint_root}/to_topic", trigger)
    to_index = start_counts_to_index(counts, index_target, f"{checkpoint_root}/to_index", trigger)
    return to_topic, to_index


def start_fanout_one_query(counts: DataFrame, counts_topic: Topic, index_target: str, checkpoint: str,
                           trigger: dict | None = None) -> StreamingQuery:
    """T6 as one query: one stateful count, each micro-batch persisted once
    and written to the index and the counts topic.

    Half the source reads and state of ``start_fanout``; the price is
    coupling (one failure stops both) and an at-least-once topic: a replayed
    micro-batch is published again.  The index stays idempotent by id.
    """

    def _write_both(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            index_writer(index_target)(df, batch_id)
            write_topic(to_frames(df, counts_topic), counts_topic)
        finally:
            df.unpersist()

    return (
        counts.writeStream.foreachBatch(_write_both)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_day_segments(spark: SparkSession, counts_topic: Topic, root: str, checkpoint: str,
                       trigger: dict | None = None, max_per_trigger: int | None = None) -> StreamingQuery:
    """T7 second hop / K6: counts topic -> day-segmented table."""
    frames = read_topic(spark, counts_topic, streaming=True, max_per_trigger=max_per_trigger)
    return write_segments_stream(to_day_segments(frames), root, checkpoint, trigger or AVAILABLE_NOW)


def drain(query: StreamingQuery) -> dict | None:
    """Wait for an ``availableNow`` query to finish, however long it takes;
    re-raise its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query.lastProgress


def _observed_by_batch(query: StreamingQuery, seen: dict[int, int], name: str, field: str) -> int:
    """Add an observed metric of batches not seen yet; return the total."""
    for progress in query.recentProgress:
        metrics = progress.get("observedMetrics") or {}
        row = metrics.get(name)
        seen.setdefault(progress["batchId"], int(row[field]) if row is not None and row[field] is not None else 0)
    return sum(seen.values())


def stop_after(query: StreamingQuery, n_rows: int, metric: str = "published", field: str = "rows",
               poll_s: float = 1.0, timeout_s: float | None = None) -> int:
    """G2 for streams: stop once the observed per-batch count ``metric``
    (see ``Dataset.observe``) adds up to at least ``n_rows``.

    Granularity is one micro-batch; bound the overshoot with
    ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``.  The exact first ``n``
    by id is the batch operator ``operators.limits.first_n``.  Returns the
    count when the query stopped.  Batches are tallied by id at each poll,
    so the progress buffer (last 100 batches) only has to cover one poll.
    """
    seen: dict[int, int] = {}
    waited = 0.0
    while query.isActive and _observed_by_batch(query, seen, metric, field) < n_rows:
        if query.awaitTermination(poll_s):
            break
        waited += poll_s
        if timeout_s is not None and waited >= timeout_s:
            break
    if query.isActive:
        query.stop()
    return _observed_by_batch(query, seen, metric, field)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """T5: rows dropped as late over the query's recent progress."""
    total = 0
    for progress in query.recentProgress:
        for op in progress.get("stateOperators", []) if isinstance(progress, dict) else progress.stateOperators:
            total += (op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark)
    return total


def to_output_times(df: DataFrame, cols=("ten_second_window",)) -> DataFrame:
    """Stream times (TIMESTAMP, UTC) -> wall-clock NTZ for comparison."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df
