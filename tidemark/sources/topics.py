"""Topics (S3, S4, D9).

A topic is a name plus a ``format``: ``"kafka"`` when the Kafka data source
is on the classpath, otherwise ``"files"``: a folder of Parquet files with
the same columns a Kafka source yields (``key value topic partition offset
timestamp timestampType``).  Readers and the operators after them cannot
tell the two apart.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.codec import parse_json_or_skip, parse_json_value
from tidemark.functions.times import unix_millis_of
from tidemark.schemas import TOPIC_FRAME


@dataclass
class Topic:
    """A named topic.  ``options`` go to the Kafka source/sink unchanged
    (e.g. ``kafka.bootstrap.servers``); ``group_id`` names the consumer
    group; reading starts at the earliest record."""

    name: str
    path: str | None = None
    format: str = "files"
    options: dict = field(default_factory=dict)
    group_id: str | None = None

    def _kafka_options(self) -> dict:
        opts = {"subscribe": self.name, "startingOffsets": "earliest"}
        if self.group_id:
            opts["kafka.group.id"] = self.group_id
        opts.update(self.options)
        return opts


def read_topic(spark: SparkSession, topic: Topic, streaming: bool = False, max_per_trigger: int | None = None,
               min_partitions: int | None = None) -> DataFrame:
    """S3: topic frames, from the earliest record.

    ``min_partitions`` splits the offset ranges of few Kafka partitions
    over that many Spark tasks, so a one-partition topic is not read and
    parsed by a single task.
    """
    if topic.format == "kafka":
        reader = (spark.readStream if streaming else spark.read).format("kafka")
        opts = topic._kafka_options()
        if streaming and max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
        if min_partitions:
            opts["minPartitions"] = str(min_partitions)
        return reader.options(**opts).load()
    if topic.format != "files":
        raise ValueError(f"unknown topic format {topic.format!r}")
    if streaming:
        reader = spark.readStream.schema(TOPIC_FRAME).option("recursiveFileLookup", True)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.parquet(topic.path)
    # Bounded publishers write a folder for each of their batches.
    return spark.read.schema(TOPIC_FRAME).option("recursiveFileLookup", True).parquet(topic.path)


def decode_topic(frames: DataFrame, schema: T.StructType, on_error: str = "fail", with_metadata: bool = False,
                 record_columns=()) -> DataFrame:
    """JSON ``value`` -> declared columns; with ``with_metadata`` the
    record timestamp is kept as epoch ms in ``kafka_timestamp``, and each of
    ``record_columns`` (``key``, ``topic``, ``partition``, ``offset`` or, where
    the source reads them, ``headers``) as ``kafka_<name>``.
    ``on_error``: ``"fail"`` (D5 default) or ``"skip"``."""
    meta = [unix_millis_of("timestamp").alias("kafka_timestamp")] if with_metadata else []
    meta += [F.col(c).alias(f"kafka_{c}") for c in record_columns]
    keep = ["kafka_timestamp"] * with_metadata + [f"kafka_{c}" for c in record_columns]
    if on_error == "skip":
        return parse_json_or_skip(frames.select("value", *meta), "value", schema, keep=keep).select(
            *[f.name for f in schema.fields], *keep
        )
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'skip', not {on_error!r}")
    out = frames.select(parse_json_value("value", schema).alias("_v"), *meta)
    return out.select(*[f"_v.{f.name}" for f in schema.fields], *keep)
