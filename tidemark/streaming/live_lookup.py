"""A lookup that is kept current while a stream runs (C4).

The lookup lies in versions, each a folder of Parquet; publishing one never
touches another.  Every micro-batch joins the version that is the latest when
the batch begins.  Which one that was is recorded beside the checkpoint before
the join, so a batch that is replayed sees the version it saw first.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tidemark import storage
from tidemark.operators.lookups import BROADCAST_BYTES, enrich, latest_from_topic
from tidemark.sources.topics import Topic, read_topic


class LookupVersions:
    """Versions of a lookup table under a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        there = storage.names(self.spark, self.root)
        return sorted(int(x) for x in there if storage.exists(self.spark, f"{self.root}/{x}/_SUCCESS"))

    def publish(self, lookup: DataFrame) -> int:
        """A new version; readers find it once it is whole."""
        version = max(self.versions(), default=0) + 1
        lookup.write.mode("overwrite").parquet(f"{self.root}/{version}")
        return version

    def publish_from_topic(self, topic: Topic, schema, key_col: str, value_cols) -> int:
        """A new version: the latest update per key of a topic."""
        return self.publish(latest_from_topic(read_topic(self.spark, topic), schema, key_col, value_cols))

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{version}")

    def vacuum(self, keep: int = 3) -> None:
        """Removes all but the latest ``keep`` versions; keep as many as a
        batch that may be replayed can have seen."""
        for version in self.versions()[:-keep]:
            storage.remove(self.spark, f"{self.root}/{version}")


def start_enriched(events: DataFrame, lookup_root: str, key_col: str, target: str, checkpoint: str, trigger: dict | None = None,
                   max_bytes: int = BROADCAST_BYTES):
    """Left join of a stream of events with the current lookup; each
    micro-batch replaces its own folder under ``target``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lookup = LookupVersions(spark, lookup_root)
        note = f"{checkpoint.rstrip('/')}/lookup/{batch_id}.json"
        if storage.exists(spark, note):
            version = json.loads(storage.read_text(spark, note))["version"]
        else:
            there = lookup.versions()
            if not there:
                raise FileNotFoundError(f"no version of the lookup under {lookup_root}")
            version = there[-1]
            storage.write_text(spark, note, json.dumps({"version": version}))
        joined = enrich(batch, lookup.read(version), key_col, max_bytes)
        joined.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{batch_id:012d}")

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_enriched(spark: SparkSession, target: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(target)
