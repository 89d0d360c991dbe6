"""Window counts and late rows from one stream (T1-T5): a window is emitted
when the watermark passes its end, and a row that comes after that is not
dropped but handed to a second sink.

Keyed state holds the open windows of a (domain, day), at most 8,640 of ten
seconds, in two arrays; an event-time timer at the end of the earliest one
wakes the key.  So a micro-batch reads and writes a key's state once, however
many windows it closes, and every row is in a count or among the late ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.windows import with_event_time
from tidemark.schemas import WATERMARK_DELAY

WINDOW_MS = 10_000
COUNT, LATE = "count", "late"
OUTPUT = "kind string, domain string, at long, n long"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Windows(StatefulProcessor):
    """Per (domain, day): ends and row counts of the open windows."""

    def __init__(self, size_ms: int):
        self.size_ms = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "ends array<long>, counts array<long>")

    def _held(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.open.exists():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ends, counts = self.open.get()
        return np.array(ends, np.int64), np.array(counts, np.int64)

    def _keep(self, ends: np.ndarray, counts: np.ndarray) -> None:
        """Stores what is open and wakes up at the earliest end."""
        if not len(ends):
            self.open.clear()
            return
        self.open.update((ends.tolist(), counts.tolist()))
        self.handle.registerTimer(int(ends.min()) - 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        at = np.concatenate([f["at"].to_numpy(np.int64) for f in rows])
        end = (at // 1000 // self.size_ms + 1) * self.size_ms
        late = at[end <= closed]
        if len(late):
            yield pd.DataFrame({"kind": LATE, "domain": _text(key[0]), "at": late, "n": 1})
        ends, counts = self._held()
        new, n = np.unique(end[end > closed], return_counts=True)
        every, place = np.unique(np.concatenate([ends, new]), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, place, np.concatenate([counts, n]))
        self._keep(every, total)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        ends, counts = self._held()
        done = ends <= closed
        if done.any():
            # A null domain is a group of its own that counts no values.
            n = counts[done] if _text(key[0]) is not None else np.zeros(int(done.sum()), np.int64)
            yield pd.DataFrame({"kind": COUNT, "domain": _text(key[0]), "at": ends[done] * 1000, "n": n})
        if not done.all():
            ends, counts = ends[~done], counts[~done]
            self.open.update((ends.tolist(), counts.tolist()))
            self.handle.registerTimer(max(int(ends.min()) - 1, closed))
        else:
            self.open.clear()

    def close(self) -> None:
        pass


def _text(value):
    return value if isinstance(value, str) else None


def counts_and_late(events: DataFrame, delay: str = WATERMARK_DELAY, size_ms: int = WINDOW_MS) -> DataFrame:
    """Stream of (domain, createTime) -> (kind, domain, at, n): ``count`` rows
    with a window's end and its number of events, ``late`` rows with the event's own
    time; times in epoch microseconds.  The time itself is handed on as a
    number, without its watermark, so that Spark doesn't drop late rows."""
    marked = with_event_time(events.select("domain", "createTime"), "createTime", delay)
    keyed = marked.select("domain", F.unix_date(F.to_date("createTime")).alias("day"), F.unix_micros("createTime").alias("at"))
    return keyed.groupBy("domain", "day").transformWithStateInPandas(_Windows(size_ms), OUTPUT, "Append", "EventTime")


@contextmanager
def _state_store(spark: SparkSession):
    """Timers and states need the RocksDB store; a query keeps the one it was
    started with."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def start_counts_and_late(events: DataFrame, counts_path: str, late_path: str, checkpoint: str, trigger: dict | None = None,
                          delay: str = WATERMARK_DELAY) -> StreamingQuery:
    """One query, two sinks; a replayed micro-batch replaces its own folders."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            time = F.timestamp_micros("at")
            batch.where(F.col("kind") == COUNT).select("domain", time.alias("ten_second_window"), F.col("n").alias("count_actions")).write.mode(
                "overwrite").parquet(f"{counts_path}/{batch_id:012d}")
            batch.where(F.col("kind") == LATE).select("domain", time.alias("createTime")).write.mode("overwrite").parquet(f"{late_path}/{batch_id:012d}")
        finally:
            batch.unpersist()

    with _state_store(events.sparkSession):
        return (
            counts_and_late(events, delay).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
        )


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("domain string, ten_second_window timestamp, count_actions long").option("recursiveFileLookup", True).parquet(path)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("domain string, createTime timestamp").option("recursiveFileLookup", True).parquet(path)
