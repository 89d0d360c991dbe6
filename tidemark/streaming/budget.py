"""A stream that publishes exactly N records, once each.

Each micro-batch writes its records under (query, batch) and replaces what an
earlier try of the same batch left there.  How many records the query has
published up to a batch is a small record beside its checkpoint, written after
the records.  A batch reads the record of the batch before it, so a batch that
is replayed after a crash, wherever it broke off, finds the same budget, picks
the same records and writes them to the same place.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tidemark import storage


class Budget:
    """The number of records a checkpointed query has published."""

    def __init__(self, checkpoint: str, most: int):
        self.folder, self.most = f"{checkpoint.rstrip('/')}/published", most

    def _batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(x.removesuffix(".json")) for x in storage.names(spark, self.folder) if x.endswith(".json"))

    def published(self, spark: SparkSession, before: int | None = None) -> int:
        """Up to the latest batch, or the latest one before batch ``before``."""
        batches = [b for b in self._batches(spark) if before is None or b < before]
        if not batches:
            return 0
        return json.loads(storage.read_text(spark, f"{self.folder}/{batches[-1]}.json"))["published"]

    def left(self, spark: SparkSession, batch: int) -> int:
        return max(0, self.most - self.published(spark, batch))

    def spent(self, spark: SparkSession) -> bool:
        return self.published(spark) >= self.most

    def record(self, spark: SparkSession, batch: int, published: int) -> None:
        storage.write_text(spark, f"{self.folder}/{batch}.json", json.dumps({"published": published}))


def publish_once(frames: DataFrame, path: str, query: str, batch: int) -> int:
    """Writes a batch's records to their own folder of a file topic, over an
    earlier try; their number."""
    own = f"{path.rstrip('/')}/{query}-{batch:012d}"
    frames.write.mode("overwrite").parquet(own)
    return frames.sparkSession.read.schema(frames.schema).parquet(own).count()
