"""Topic writes (K3, K5): rows -> JSON frames -> topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codec import json_value
from tidemark.sources.topics import Topic


def to_frames(df: DataFrame, topic: Topic, value_cols=None, key_col: str | None = None, timestamp_col: str | None = None) -> DataFrame:
    """Rows -> topic frames.  ``timestamp_col`` sets the record timestamp
    (a Kafka sink assigns its own when the column is absent)."""
    cols = value_cols or df.columns
    key = F.col(key_col).cast("string").cast("binary") if key_col else F.lit(None).cast("binary")
    ts = F.col(timestamp_col).cast("timestamp") if timestamp_col else F.current_timestamp()
    return df.select(
        key.alias("key"),
        json_value(*cols).alias("value"),
        F.lit(topic.name).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def to_text_frames(df: DataFrame, topic: Topic, text_col: str = "value", timestamp_col: str | None = None) -> DataFrame:
    """Text records (already serialised, e.g. raw events) -> topic frames."""
    ts = F.col(timestamp_col).cast("timestamp") if timestamp_col else F.current_timestamp()
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.col(text_col).cast("binary").alias("value"),
        F.lit(topic.name).alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_topic(frames: DataFrame, topic: Topic) -> None:
    """Batch publish."""
    if topic.format == "kafka":
        frames.select("key", "value").write.format("kafka").options(topic=topic.name, **topic.options).save()
    else:
        frames.write.mode("append").parquet(topic.path)


def write_topic_stream(frames: DataFrame, topic: Topic, checkpoint: str, trigger: dict | None = None, output_mode: str = "append"):
    """Stream publish; the checkpoint makes the file form exactly once."""
    if topic.format == "kafka":
        writer = frames.select("key", "value").writeStream.format("kafka").options(topic=topic.name, **topic.options)
    else:
        writer = frames.writeStream.format("parquet").option("path", topic.path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode(output_mode)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
