"""Partitioned writes that replace what they answer for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, root: str, format: str, column: str, mode: str = "overwrite", answers_for: Iterable | None = None) -> None:
    """Writes ``df`` under ``root``, one folder per value of ``column`` (a
    date).  ``overwrite`` replaces the partitions that have rows and, of
    ``answers_for``, empties those that have none; all others stay.  Which
    ones have rows is observed while they are written: the input is computed
    once.  What reaches the driver is one value per partition."""
    if mode != "overwrite" or answers_for is None:
        _save(df, root, format, column, mode)
        return
    seen = Observation()
    _save(df.observe(seen, F.collect_set(column).alias("there")), root, format, column, mode)
    there = set(seen.get["there"] or ())
    empty = df.sparkSession.createDataFrame([], df.drop(column).schema)
    for value in sorted(set(answers_for) - there):
        empty.write.mode("overwrite").option("partitionOverwriteMode", "static").format(format).save(f"{root}/{column}={value.isoformat()}")


def _save(df: DataFrame, root: str, format: str, column: str, mode: str) -> None:
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).format(format).save(root)
