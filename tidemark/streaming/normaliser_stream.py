"""The edit-event normaliser as a stream.

raw change-event text --parse, skip non-JSON--> keep edits, reshape
  --> JSON frames --> events topic

The same operators run on a batch table; only the source and the sink
differ.  The file form of the topic is written by a checkpointed file sink,
so a restarted run publishes every record exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.events import normalise_edits, parse_raw_edits
from tidemark.operators.limits import first_n
from tidemark.sinks.topics import to_frames, write_topic, write_topic_stream
from tidemark.sources.topics import Topic, read_topic
from tidemark.streaming.budget import Budget, publish_once


def normalised_edits(raw_text: DataFrame, text_col: str = "value", kind_col: str | None = None) -> DataFrame:
    return normalise_edits(parse_raw_edits(raw_text, text_col, on_error="skip", kind_col=kind_col))


def raw_topic_stream(spark: SparkSession, raw: Topic, max_per_trigger: int | None = None,
                     min_partitions: int | None = None) -> DataFrame:
    """Raw event text as it arrives on a topic (the ``value`` bytes)."""
    frames = read_topic(spark, raw, streaming=True, max_per_trigger=max_per_trigger, min_partitions=min_partitions)
    return frames.select("value", *[c for c in frames.columns if c != "value"])


# Name of the observed per-batch metric with the number of published events.
PUBLISHED_METRIC = "published"


def start_normaliser(raw_text: DataFrame, events_topic: Topic, checkpoint: str, trigger: dict | None = None,
                     kind_col: str | None = None, max_events: int | None = None) -> StreamingQuery:
    """Publish normalised edits; the record time is the publish time.  Each
    micro-batch reports ``observedMetrics["published"]["rows"]``.

    With ``max_events`` exactly that many are published (G2): the micro-batch
    that reaches the budget publishes the first of its events by id, later
    ones nothing, and :func:`wait` stops the query.  The budget is the
    checkpoint's: a restarted query goes on where it was, and a batch replayed
    after a crash replaces its own records (a file topic; a Kafka topic, which
    cannot be overwritten, may get that one batch twice).
    """
    edits = normalised_edits(raw_text, kind_col=kind_col)
    if max_events is None:
        observed = edits.observe(PUBLISHED_METRIC, F.count(F.lit(1)).alias("rows"))
        return write_topic_stream(to_frames(observed, events_topic), events_topic, checkpoint, trigger)

    budget = Budget(checkpoint, max_events)

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        left = budget.left(spark, batch_id)
        if left <= 0:
            return
        batch.persist()  # the first n are found and taken in several passes
        try:
            frames = to_frames(first_n(batch, left, "id"), events_topic)
            if events_topic.format == "files":
                query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
                n = publish_once(frames, events_topic.path, query, batch_id)
            else:
                seen = Observation()
                write_topic(frames.observe(seen, F.count(F.lit(1)).alias("n")), events_topic)
                n = seen.get["n"]
        finally:
            batch.unpersist()
        budget.record(spark, batch_id, budget.published(spark, batch_id) + n)

    query = (
        edits.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(**(trigger or {"availableNow": True})).start()
    )
    BUDGETS[query.id] = budget
    return query


#: Budgets of the bounded queries that this process started.
BUDGETS: dict[str, Budget] = {}


def wait(query: StreamingQuery, poll_s: float = 5.0) -> None:
    """Until the query ends, or its budget is spent."""
    budget = BUDGETS.get(query.id)
    while not query.awaitTermination(poll_s):
        if budget is not None and budget.spent(SparkSession.active()):
            query.stop()
