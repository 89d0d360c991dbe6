"""Raw and trusted layer writes (K1, K2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.sinks.partitions import write_partitions

PARTITION_COL = "processing_date"


def _balanced(df: DataFrame, *cols: str) -> DataFrame:
    """Rebalance by the partition column before a partitioned write.

    Rows of one run date meet in few tasks, so each date is written as a
    few large files instead of one small file per upstream task; with AQE
    a date holding a large share of the rows is split over several tasks
    (skew split) and small dates are coalesced.  No fixed file count.
    """
    return df.hint("rebalance", *cols)


def _write(df: DataFrame, root: str, format: str, mode: str, runs: Iterable | None) -> None:
    write_partitions(_balanced(df, PARTITION_COL), root, format, PARTITION_COL, mode, runs)


def write_raw(df: DataFrame, root: str, mode: str = "overwrite", runs: Iterable | None = None) -> None:
    """K1: raw records as JSON lines under ``processing_date=<ds>/``.

    ``overwrite`` replaces the run dates present in ``df`` and those in
    ``runs``, the dates the job answers for: one of them without rows becomes
    empty.  Other days are left alone.
    """
    _write(df, root, "json", mode, runs)


def write_trusted(df: DataFrame, root: str, mode: str = "overwrite", runs: Iterable | None = None) -> None:
    """K2: trusted rows as Parquet partitioned by run date.

    ``mode="append"`` behaves like the original job (a repeated run adds its
    rows again); ``"overwrite"`` (default, D6/J4) replaces the run's
    partitions only (those in ``runs`` even if they come out empty) and is
    safe to retry.
    """
    _write(df, root, "parquet", mode, runs)
