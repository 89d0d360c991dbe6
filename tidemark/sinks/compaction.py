"""Day table fed by a stream, compacted in versions (K6).

    <root>/stream/<batch>/        one folder for each micro-batch, small files
    <root>/compacted/<version>/   whole days, few files: segment=<day>/
    <root>/manifest/<version>.json

A micro-batch replaces its own folder, so a replay leaves no copies.
Compaction rewrites the days that new batches touched, together with what the
last version had of them, and then writes a manifest: the batch it goes up to
and, for each day, the version that holds it.  The manifest is written whole or
not at all, and nothing is removed, so a reader sees one version: the one whose
manifest it read, and the batches after it.  ``vacuum`` removes what the latest
``keep`` versions don't need, once no reader of older ones is left.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.schemas import DAY_SEGMENT


def _batch_name(batch: int) -> str:
    return f"{batch:012d}"


def write_batches(rows: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Continuous load of day-table rows, exactly once: each micro-batch into
    its own folder, replaced when it is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, root, batch_id)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def add_batch(rows: DataFrame, root: str, batch: int) -> None:
    """One micro-batch, ``segment=<day>`` folders; the day stays a column."""
    _replace(rows.withColumn("segment", F.col("segment_day")), f"{root}/stream/{_batch_name(batch)}")


def _replace(rows: DataFrame, folder: str) -> None:
    """The whole folder is replaced, whatever the session's own mode is."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("segment").parquet(folder)


def _whole(spark: SparkSession, folder: str) -> list[str]:
    """Sub-folders whose write was committed."""
    return [x for x in storage.names(spark, folder) if storage.exists(spark, f"{folder}/{x}/_SUCCESS")]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """{version, through, days}: ``days`` maps a day to the version that holds
    it; of the latest version if none is named."""
    if version is None:
        there = [int(x.removesuffix(".json")) for x in storage.names(spark, f"{root}/manifest") if x.endswith(".json")]
        if not there:
            return {"version": 0, "through": -1, "days": {}}
        version = max(there)
    return json.loads(storage.read_text(spark, f"{root}/manifest/{version}.json"))


def _days_of(spark: SparkSession, folder: str) -> list[str]:
    return [x.split("=", 1)[1] for x in storage.names(spark, folder) if x.startswith("segment=")]


def _folders(spark: SparkSession, root: str, now: dict, keep) -> list[str]:
    """The day folders of a version and of the batches after it, of the days
    that ``keep`` accepts."""
    out = [f"{root}/compacted/{v}/segment={d}" for d, v in now["days"].items() if keep(d)]
    for batch in _whole(spark, f"{root}/stream"):
        if int(batch) > now["through"]:
            folder = f"{root}/stream/{batch}"
            out += [f"{folder}/segment={d}" for d in _days_of(spark, folder) if keep(d)]
    return out


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], DAY_SEGMENT)
    return spark.read.schema(DAY_SEGMENT).parquet(*folders)


def read_compacted(spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None, version: int | None = None) -> DataFrame:
    """Rows of the days in [start, end), either bound optional: of the latest
    version and the batches after it, or of one version alone.  Only folders
    of those days are listed and read."""
    now = manifest(spark, root, version)

    def keep(day: str) -> bool:
        if day == "__HIVE_DEFAULT_PARTITION__":  # rows without a time
            return start is None and end is None
        d = dt.date.fromisoformat(day)
        return (start is None or d >= start) and (end is None or d < end)

    if version is not None:
        return _read(spark, [f"{root}/compacted/{v}/segment={d}" for d, v in now["days"].items() if keep(d)])
    return _read(spark, _folders(spark, root, now, keep))


def compact(spark: SparkSession, root: str) -> int:
    """A new version that holds all complete batches; its number (that of the
    latest version, if there is nothing new).  One job rewrites the touched
    days, rebalanced by day, so a day is a few files of the size that adaptive
    execution aims at, however many batches it came in.  One compaction at a
    time: the stream may go on meanwhile."""
    old = manifest(spark, root)
    new = [b for b in _whole(spark, f"{root}/stream") if int(b) > old["through"]]
    if not new:
        return old["version"]
    touched = {d for b in new for d in _days_of(spark, f"{root}/stream/{b}")}
    version = old["version"] + 1
    if touched:
        folders = [f"{root}/stream/{b}/segment={d}" for b in new for d in _days_of(spark, f"{root}/stream/{b}")]
        folders += [f"{root}/compacted/{v}/segment={d}" for d, v in old["days"].items() if d in touched]
        rows = _read(spark, folders).withColumn("segment", F.col("segment_day"))
        _replace(rows.hint("rebalance", "segment").sortWithinPartitions("segment", "__time"), f"{root}/compacted/{version}")
    made = {"version": version, "through": int(new[-1]), "days": {**old["days"], **dict.fromkeys(sorted(touched), version)}}
    storage.write_text(spark, f"{root}/manifest/{version}.json", json.dumps(made))
    return version


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Removes batches and compacted days that the latest ``keep`` versions
    don't need."""
    versions = sorted(int(x.removesuffix(".json")) for x in storage.names(spark, f"{root}/manifest") if x.endswith(".json"))
    kept = [manifest(spark, root, v) for v in versions[-keep:]]
    if not kept:
        return
    for v in versions[:-keep]:
        storage.remove(spark, f"{root}/manifest/{v}.json")
    through = min(m["through"] for m in kept)
    for batch in storage.names(spark, f"{root}/stream"):
        if int(batch) <= through:
            storage.remove(spark, f"{root}/stream/{batch}")
    needed = {(str(v), d) for m in kept for d, v in m["days"].items()}
    for v in storage.names(spark, f"{root}/compacted"):
        for day in _days_of(spark, f"{root}/compacted/{v}"):
            if (v, day) not in needed:
                storage.remove(spark, f"{root}/compacted/{v}/segment={day}")
