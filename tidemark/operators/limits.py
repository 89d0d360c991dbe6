"""Bounded run (G2): the first ``n`` rows by a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Ranges that keys are dealt to, and keys that may reach the driver.
RANGES, FEW = 64, 10_000


def _comparable(c: Column, kind: T.DataType) -> Column:
    """A key whose values mean the same on the driver, whatever its zone."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return F.unix_date(c) if isinstance(kind, T.DateType) else c


def _before(key: list[Column], bound: list, inclusive: bool) -> Column:
    """Whether the key columns, in order, come before the bound's values (or
    are equal to them)."""
    out = F.lit(inclusive)
    for c, b in reversed(list(zip(key, bound))):
        if b is None:  # only the order column, whose flag before it is equal then
            continue
        out = (c < F.lit(b)) | ((c == F.lit(b)) & out)
    return out


def _in_order(key: list):
    """Spark's order of (flag, key, hash): nulls last, NaN the largest."""
    flag, value, row = key
    return flag, value != value, 0 if value is None or value != value else value, row


def _cut(keys: DataFrame, names: list[str], n: int):
    """(key of the n-th row, how many rows with that key belong to the first
    n, how many there are), or None if there are at most n rows.

    Spark's range partitioning deals the keys; each range's row count, least
    and greatest key reach the driver, and the range that holds the n-th row
    is dealt again until it is small or holds one key."""
    bound, order = F.struct(*names), [F.col(x).asc_nulls_last() for x in names]
    while True:
        ranges = (
            keys.repartitionByRange(RANGES, *order).groupBy(F.spark_partition_id().alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(bound).alias("low"), F.max(bound).alias("high")).collect()
        )
        for own in sorted(ranges, key=lambda r: r["part"]):  # ranges are numbered in order
            if n <= own["n"]:
                break
            n -= own["n"]
        else:
            return None
        low, high = list(own["low"]), list(own["high"])
        if low == high:
            return low, n, own["n"]
        columns = [F.col(x) for x in names]
        keys = keys.where(~_before(columns, low, False) & _before(columns, high, True))
        if own["n"] <= FEW:
            seen = sorted((list(r) for r in keys.collect()), key=_in_order)
            key = seen[n - 1]
            return key, n - seen.index(key), seen.count(key)


def first_n(df: DataFrame, n: int, order_col: str = "id") -> DataFrame:
    """``ORDER BY order_col LIMIT n`` (nulls last), the same plan for any
    ``n`` and any size.

    The key is the order column and a hash of the row, to tell ties apart.
    The n-th key is found by range partitions (:func:`_cut`); the result is a
    filter on the key, so no task merges candidates.  Of rows alike in all
    columns as many copies as are due are taken.  For streams use
    ``streaming.window_stream.stop_after``.
    """
    order = F.col(order_col).asc_nulls_last()
    if n <= 0:
        return df.where(F.lit(False))
    key = [
        F.col(order_col).isNull().cast("int"), _comparable(F.col(order_col), df.schema[order_col].dataType),
        F.xxhash64(F.to_json(F.struct(*df.columns))),
    ]
    names = ["_flag", "_key", "_hash"]
    found = _cut(df.select(*[c.alias(x) for c, x in zip(key, names)]), names, n)
    if found is None:
        return df.orderBy(order)
    cut, due, there = found
    if due == there:
        return df.where(_before(key, cut, True)).orderBy(order)
    before = _before(key, cut, False)
    return df.where(before).unionByName(df.where(~before & _before(key, cut, True)).limit(due)).orderBy(order)
