"""Day-segmented table scan with time pruning (K6 read side).

A filter on ``__time`` alone reads every day folder; the same bounds on the
partition column ``segment_day`` let Spark list and read only those days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import DAY_SEGMENT


def _as_datetime(t) -> dt.datetime:
    if isinstance(t, dt.datetime):
        return t
    if isinstance(t, dt.date):
        return dt.datetime(t.year, t.month, t.day)
    return dt.datetime.fromisoformat(str(t))


def read_segments(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= __time < end`` (either bound optional), with the
    matching ``segment_day`` bounds added for partition pruning."""
    df = spark.read.schema(DAY_SEGMENT).parquet(root)
    if start is not None:
        lo = _as_datetime(start)
        df = df.where((F.col("__time") >= _session_time(lo)) & (F.col("segment_day") >= F.lit(lo.date())))
    if end is not None:
        hi = _as_datetime(end)
        df = df.where((F.col("__time") < _session_time(hi)) & (F.col("segment_day") <= F.lit((hi - dt.timedelta(microseconds=1)).date())))
    return df


def _session_time(t: dt.datetime):
    """A wall-clock bound read in the session time zone (UTC), not in the
    Python process's local zone."""
    return F.to_timestamp(F.lit(t.isoformat(sep=" ")))
