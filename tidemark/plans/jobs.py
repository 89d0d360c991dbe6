"""Daily batch jobs (J1-J4) with a ``spark-submit`` entry point.

    spark-submit --py-files tidemark.zip tidemark/plans/jobs.py daily --date 2024-01-15 \
        --replies s3a://bucket/replies/2024-01-15 \
        --raw-root s3a://bucket/raw --trusted-root s3a://bucket/trusted
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.pageviews import (
    allowlist_filter,
    as_date,
    explode_run_dates,
    flatten_replies,
    trusted_from_raw_root,
    trusted_transform,
)
from tidemark.plans.ledger import RunLedger, catch_up
from tidemark.schemas import PAGEVIEW_DOMAINS
from tidemark.session import CLUSTER_BATCH_CONF, build_session, configure
from tidemark.sinks import compaction
from tidemark.sinks.layers import write_raw, write_trusted
from tidemark.sources.rawjson import read_raw, read_raw_run


def _dates(start, end) -> list[dt.date]:
    first, last = as_date(start), as_date(end)
    return [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]


def raw_job(spark: SparkSession, ds, replies: DataFrame, raw_root: str, reply_col: str = "reply",
            domains=PAGEVIEW_DOMAINS, on_error: str = "fail") -> None:
    """J1 raw step: service replies for run ``ds`` -> flat records of the
    collected domains (P17; ``None``: all) under ``processing_date=ds``; a
    rerun replaces that folder, even with nothing (K1)."""
    configure(spark)
    records = flatten_replies(replies, reply_col, on_error)
    if domains is not None:
        records = allowlist_filter(records, domains)
    write_raw(records.withColumn("processing_date", F.lit(as_date(ds))), raw_root, runs=[as_date(ds)])


def trusted_job(spark: SparkSession, ds, raw_root: str, trusted_root: str, mode: str = "overwrite",
                multiline: bool = False) -> None:
    """J1 trusted step: one run's raw partition -> trusted partition.
    ``mode="append"`` repeats the original behaviour; the default is safe to
    retry (J4)."""
    configure(spark)
    raw = read_raw_run(spark, raw_root, ds, multiline=multiline).drop("processing_date")
    write_trusted(trusted_transform(raw, ds), trusted_root, mode=mode, runs=[as_date(ds)])


def daily_job(spark: SparkSession, ds, replies: DataFrame, raw_root: str, trusted_root: str,
              domains=PAGEVIEW_DOMAINS, on_error: str = "fail", **kw) -> None:
    """Raw, then trusted, for one run date."""
    raw_job(spark, ds, replies, raw_root, domains=domains, on_error=on_error)
    trusted_job(spark, ds, raw_root, trusted_root, **kw)


def backfill_from_raw(spark: SparkSession, start, end, raw_root: str, trusted_root: str) -> None:
    """J3 (a): every run date in [start, end] in one job from the raw root."""
    configure(spark)
    rows = trusted_from_raw_root(read_raw(spark, raw_root), start, end)
    write_trusted(rows, trusted_root, runs=_dates(start, end))


def backfill_from_pageviews(spark: SparkSession, start, end, pageviews: DataFrame, trusted_root: str) -> None:
    """J3 (b): every run date in [start, end] from one pageview table
    (columns domain, pageviews, pageview_date)."""
    configure(spark)
    write_trusted(explode_run_dates(pageviews, start, end), trusted_root, runs=_dates(start, end))


def run_cli(argv=None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(description="pageview batch jobs")
    p.add_argument("step", choices=["raw", "daily", "trusted", "backfill", "catchup", "compact"])
    p.add_argument("--replies", help="raw, daily: service replies, one JSON object per line")
    p.add_argument("--date", help="run date yyyy-MM-dd (raw, daily, trusted)")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--raw-root")
    p.add_argument("--trusted-root")
    p.add_argument("--ledger", help="catchup: folder of the run ledger")
    p.add_argument("--step-days", type=int, default=1, help="catchup: run dates in one run")
    p.add_argument("--table", help="compact: day table written in micro-batch folders")
    p.add_argument("--keep", type=int, default=2, help="compact: versions that readers may still use")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--multiline", action="store_true", help="raw files are JSON arrays, one per file")
    p.add_argument("--domains", nargs="*", help="raw, daily: domains to collect (default: the fixed list)")
    p.add_argument("--on-error", default="fail", choices=["fail", "skip"], help="raw, daily: bad replies and entries")
    a = p.parse_args(argv)
    layers = ["raw_root", "trusted_root"]
    needed = {
        "raw": ["date", "replies", *layers], "daily": ["date", "replies", *layers], "trusted": ["date", *layers],
        "backfill": ["start", "end", *layers], "catchup": ["start", "end", "ledger", *layers], "compact": ["table"],
    }[a.step]
    missing = [f"--{name.replace('_', '-')}" for name in needed if getattr(a, name) is None]
    if missing:
        p.error(f"{a.step} needs {' '.join(missing)}")
    spark = spark or build_session(app_name=f"tidemark-{a.step}", extra=CLUSTER_BATCH_CONF)
    domains = PAGEVIEW_DOMAINS if a.domains is None else a.domains
    if a.step in ("raw", "daily"):
        replies = spark.read.text(a.replies).withColumnRenamed("value", "reply")
        if a.step == "raw":
            raw_job(spark, a.date, replies, a.raw_root, domains=domains, on_error=a.on_error)
        else:
            daily_job(spark, a.date, replies, a.raw_root, a.trusted_root, domains, a.on_error, mode=a.mode)
    elif a.step == "catchup":
        catch_up(
            RunLedger(spark, a.ledger), a.start, a.end,
            lambda first, last: backfill_from_raw(spark, first, last, a.raw_root, a.trusted_root), a.step_days,
        )
    elif a.step == "compact":
        compaction.compact(spark, a.table)
        compaction.vacuum(spark, a.table, a.keep)
    elif a.step == "trusted":
        trusted_job(spark, a.date, a.raw_root, a.trusted_root, a.mode, multiline=a.multiline)
    else:
        backfill_from_raw(spark, a.start, a.end, a.raw_root, a.trusted_root)


def main(argv=None) -> None:
    run_cli(argv)


if __name__ == "__main__":
    main()
