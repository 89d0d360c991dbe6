"""Pageview flattening, trusted transform and backfill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookups import BROADCAST_BYTES, bounded_broadcast
from tidemark.schemas import TRUSTED_LOOKBACK_DAYS


def as_date(ds) -> dt.date:
    if isinstance(ds, dt.datetime):
        return ds.date()
    if isinstance(ds, dt.date):
        return ds
    return dt.date.fromisoformat(str(ds))


def flatten_replies(df: DataFrame, reply_col: str = "reply", on_error: str = "fail") -> DataFrame:
    """Date -> domain -> views replies to one row per (date, domain).

    ``on_error="fail"`` (default): a reply that is not such JSON, or a view
    count that is not a whole number, stops the job, so that a bad reply never
    looks like a good day.  ``"skip"``: bad replies and bad entries are left
    out, good entries of the same reply stay.  Null views are kept; an empty
    inner map yields no row.  Pure per-row generators: no shuffle.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be 'fail' or 'skip', not {on_error!r}")
    reply = F.col(reply_col)
    if dict(df.dtypes)[reply_col] != "string":
        by_domain = df.select(F.explode(reply).alias("date", "_by_domain"))
        return by_domain.select("date", F.explode("_by_domain").alias("domain", "pageviews"))
    days = F.from_json(reply, "map<string,string>", {"mode": "FAILFAST" if on_error == "fail" else "PERMISSIVE"})
    entries = df.select(F.explode(days).alias("date", "_entries"))
    by_domain = F.from_json("_entries", "map<string,string>", {"mode": "FAILFAST" if on_error == "fail" else "PERMISSIVE"})
    flat = entries.select("date", F.explode(by_domain).alias("domain", "_views"))
    views = F.col("_views").try_cast("bigint")
    bad = F.col("_views").isNotNull() & views.isNull()
    if on_error == "skip":
        return flat.where(~bad).select("date", "domain", views.alias("pageviews"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not a view count: "), F.col("_views"))).cast("bigint")).otherwise(views)
    return flat.select("date", "domain", checked.alias("pageviews"))


def trusted_window(pageview_date: Column, run_date: Column, days: int = TRUSTED_LOOKBACK_DAYS) -> Column:
    """``run_date - days <= pageview_date < run_date``; null drops out."""
    return (pageview_date < run_date) & (pageview_date >= F.date_sub(run_date, days))


def trusted_transform(raw: DataFrame, ds, days: int = TRUSTED_LOOKBACK_DAYS) -> DataFrame:
    """P1-P7 for one run date ``ds``: typed date, 7-day window, run date column.

    Bad date text becomes null (D4) and fails the filter.  The date is parsed
    from text, so the filter runs after the scan of the run's partition.
    """
    run = as_date(ds)
    lower = run - dt.timedelta(days=days)
    return (
        raw.withColumn("pageview_date", F.try_to_date(F.col("date"), "yyyy-MM-dd"))
        .drop("date")
        .where((F.col("pageview_date") < F.lit(run)) & (F.col("pageview_date") >= F.lit(lower)))
        .withColumn("processing_date", F.lit(run))
        .select("domain", "pageviews", "pageview_date", "processing_date")
    )


def trusted_from_raw_root(raw: DataFrame, start=None, end=None, days: int = TRUSTED_LOOKBACK_DAYS) -> DataFrame:
    """J3 (a): many runs at once from the raw root.  Each row is checked
    against its own partition's run date; the same rows as one run per day.
    ``start``/``end`` (inclusive) prune raw partitions."""
    df = raw
    if start is not None:
        df = df.where(F.col("processing_date") >= F.lit(as_date(start)))
    if end is not None:
        df = df.where(F.col("processing_date") <= F.lit(as_date(end)))
    return (
        df.withColumn("pageview_date", F.try_to_date(F.col("date"), "yyyy-MM-dd"))
        .where(trusted_window(F.col("pageview_date"), F.col("processing_date"), days))
        .select("domain", "pageviews", "pageview_date", "processing_date")
    )


def explode_run_dates(
    pageviews: DataFrame,
    start,
    end,
    date_col: str = "pageview_date",
    days: int = TRUSTED_LOOKBACK_DAYS,
) -> DataFrame:
    """J3 (b): one pageview table, every run date in ``[start, end]``.

    A date ``d`` belongs to runs ``d+1 … d+days``; each row is copied to
    exactly those runs (a bounded, per-row ``explode``) instead of a range
    join, which Spark would plan as a nested loop.  Rows whose dates cannot
    reach the run range are filtered before the copy.
    """
    first, last = as_date(start), as_date(end)
    d = F.col(date_col)
    return (
        pageviews.where(
            (d >= F.lit(first - dt.timedelta(days=days))) & (d < F.lit(last))
        )
        .withColumn(
            "processing_date",
            F.explode(F.sequence(F.date_add(d, 1), F.date_add(d, days))),
        )
        .where(F.col("processing_date").between(F.lit(first), F.lit(last)))
    )


def allowlist_filter(df: DataFrame, allowed, col: str = "domain", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Keep rows whose ``col`` is allowed.

    A Python list becomes an ``IN`` set (hash probe in generated code).  A
    DataFrame list becomes a left-semi join, broadcast only up to
    ``max_bytes`` as measured; otherwise a shuffled semi join.
    """
    if isinstance(allowed, DataFrame):
        keys = allowed.select(F.col(allowed.columns[0]).alias("_allowed")).distinct()
        right = bounded_broadcast(keys, max_bytes)
        return df.join(right, df[col] == right["_allowed"], "left_semi")
    return df.where(F.col(col).isin(list(allowed)))
