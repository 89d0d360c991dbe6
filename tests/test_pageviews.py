"""S1, S2, S7, K1, K2, P1-P7, P17, J1-J4 on FIXTURES F1-F3 rows."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.pageviews import (
    allowlist_filter,
    explode_run_dates,
    flatten_replies,
    trusted_from_raw_root,
    trusted_transform,
)
from tidemark.plans import jobs
from tidemark.schemas import PAGEVIEW_DOMAINS, TRUSTED_PAGEVIEW
from tidemark.sinks.layers import write_raw, write_trusted
from tidemark.sources.rawjson import read_raw, read_raw_run

from paths import local_path
from plans import plan_text

DS = dt.date(2024, 1, 15)


def test_flatten_replies_edges(spark):
    replies = [
        json.dumps({"2024-01-10": {"aa.site": 12, "bb.site": 7}}),
        json.dumps({"2024-01-10": {"cc.site": None}}),
        json.dumps({"2024-01-11": {}}),
        '{"2024-01-14":{"a":5,"b":"oops"}}',
        "not json",
    ]
    df = spark.createDataFrame([(r,) for r in replies], "reply string")
    for good in range(3):
        flatten_replies(df.limit(good)).collect()
    for bad in replies[3:]:
        with pytest.raises(Exception):
            flatten_replies(spark.createDataFrame([(bad,)], "reply string")).collect()
    out = sorted(tuple(r) for r in flatten_replies(df, on_error="skip").collect())
    assert out.pop() == ("2024-01-14", "a", 5)
    assert out == [("2024-01-10", "aa.site", 12), ("2024-01-10", "bb.site", 7), ("2024-01-10", "cc.site", None)]


def _raw_rows():
    return [
        ("bad", "en.wikipedia", 1),
        (None, "en.wikipedia", 2),
        ("2024-01-15", "en.wikipedia", 3),  # ds itself: out
        ("2024-01-14", "en.wikipedia", 4),  # ds-1: in
        ("2024-01-08", "en.wikipedia", 5),  # ds-7: in
        ("2024-01-07", "en.wikipedia", 6),  # ds-8: out
        ("2024-01-10", None, 7),
        ("2024-01-10", "xx.unlisted", None),
        ("2024-01-10", "fr.wikipedia", 0),
    ]


def test_trusted_transform_window_and_types(spark):
    raw = spark.createDataFrame(_raw_rows(), "date string, domain string, pageviews bigint")
    out = trusted_transform(raw, "2024-01-15")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TRUSTED_PAGEVIEW]
    got = sorted(r.pageviews for r in out.collect() if r.pageviews is not None)
    assert got == [0, 4, 5, 7]
    assert out.count() == 5
    # property: every row lies in [ds-7, ds) and carries the run date
    assert out.where(~((F.col("pageview_date") >= F.lit(DS - dt.timedelta(7))) & (F.col("pageview_date") < F.lit(DS)))).count() == 0
    assert {r.processing_date for r in out.collect()} == {DS}


def test_allowlist_list_and_table(spark):
    df = spark.createDataFrame([("en.wikipedia", 1), ("xx.unlisted", 2), (None, 3)], "domain string, v int")
    assert [r.v for r in allowlist_filter(df, PAGEVIEW_DOMAINS).collect()] == [1]
    allowed = spark.createDataFrame([(d,) for d in PAGEVIEW_DOMAINS], "d string")
    semi = allowlist_filter(df, allowed)
    assert [r.v for r in semi.collect()] == [1]
    assert "BroadcastHashJoin" in plan_text(semi, "simple") or "LeftSemi" in plan_text(semi, "simple")


def test_multiline_array_scan(spark, scratch):
    folder = local_path(f"{scratch}/raw/processing_date=2024-01-15")
    os.makedirs(folder)
    records = [{"date": d, "domain": dom, "pageviews": v} for d, dom, v in _raw_rows()]
    with open(f"{folder}/data.json", "w") as fh:
        json.dump(records, fh, indent=4)
    df = read_raw(spark, f"{scratch}/raw", multiline=True)
    assert df.count() == len(records)
    assert {r.processing_date for r in df.collect()} == {DS}


def test_raw_layer_rerun_and_partition_scan(spark, scratch):
    rows = [("2024-01-10", "en.wikipedia", 1, dt.date(2024, 1, 11)), ("2024-01-11", "en.wikipedia", 2, dt.date(2024, 1, 12))]
    df = spark.createDataFrame(rows, "date string, domain string, pageviews bigint, processing_date date")
    root = f"{scratch}/raw"
    write_raw(df, root)
    write_raw(df.where(F.col("pageviews") == 2), root)  # rerun of one day
    assert read_raw(spark, root).count() == 2
    one = read_raw_run(spark, root, "2024-01-12")
    assert [r.pageviews for r in one.collect()] == [2]
    plan = plan_text(one, "simple")
    assert "PartitionFilters: [isnotnull(processing_date" in plan


def test_trusted_append_vs_overwrite(spark, scratch):
    raw = spark.createDataFrame(_raw_rows(), "date string, domain string, pageviews bigint")
    rows = trusted_transform(raw, DS)
    append_root, over_root = f"{scratch}/append", f"{scratch}/overwrite"
    for _ in range(2):
        write_trusted(rows, append_root, mode="append")
        write_trusted(rows, over_root, mode="overwrite")
    assert spark.read.parquet(append_root).count() == 2 * rows.count()
    assert spark.read.parquet(over_root).count() == rows.count()
    # overwriting one run date keeps the others
    other = trusted_transform(raw, DS + dt.timedelta(days=1))
    write_trusted(other, over_root, mode="overwrite")
    assert spark.read.parquet(over_root).count() == rows.count() + other.count()


def test_backfill_forms_agree_with_single_runs(spark, scratch):
    days = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(20)]
    daily = spark.createDataFrame([(d, "en.wikipedia", 10 + i) for i, d in enumerate(days)],
                                  "pageview_date date, domain string, pageviews bigint")
    start, end = dt.date(2024, 1, 8), dt.date(2024, 1, 12)
    b = explode_run_dates(daily, start, end).select("domain", "pageviews", "pageview_date", "processing_date")
    # raw root: every run's reply holds all days; the filter keeps its window
    raw_root = f"{scratch}/raw"
    run_dates = F.array(*[F.lit(start + dt.timedelta(i)) for i in range(5)])
    raw = daily.select(F.date_format("pageview_date", "yyyy-MM-dd").alias("date"), "domain", "pageviews",
                       F.explode(run_dates).alias("processing_date"))
    write_raw(raw, raw_root)
    a = trusted_from_raw_root(read_raw(spark, raw_root), start, end)
    singles = None
    for i in range(5):
        ds = start + dt.timedelta(i)
        one = trusted_transform(read_raw_run(spark, raw_root, ds).drop("processing_date"), ds)
        singles = one if singles is None else singles.unionByName(one)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(a) == key(b) == key(singles)
    assert len(key(b)) == 5 * 7


def test_daily_job_end_to_end(spark, scratch):
    replies = spark.createDataFrame(
        [(json.dumps({"2024-01-14": {"en.wikipedia": 3}, "2024-01-15": {"en.wikipedia": 9}}),)], "reply string"
    )
    jobs.daily_job(spark, "2024-01-15", replies, f"{scratch}/raw", f"{scratch}/trusted")
    jobs.trusted_job(spark, "2024-01-15", f"{scratch}/raw", f"{scratch}/trusted")  # retry
    out = spark.read.parquet(f"{scratch}/trusted").collect()
    assert [(r.domain, r.pageviews, r.pageview_date, r.processing_date) for r in out] == [
        ("en.wikipedia", 3, dt.date(2024, 1, 14), DS)
    ]


def test_hot_run_date_is_split_over_writers(spark, scratch):
    """A run date holding most rows is written by several tasks (AQE splits
    the rebalance partition), the small dates are coalesced."""
    hot = spark.range(0, 30000).select(
        F.lit("2024-01-14").alias("date"),
        F.concat(F.lit("d"), (F.col("id") % 997).cast("string")).alias("domain"),
        F.col("id").alias("pageviews"),
        F.lit(DS).alias("processing_date"),
    )
    cold = spark.createDataFrame([("2024-01-13", "en.wikipedia", 1, DS + dt.timedelta(days=1))],
                                 "date string, domain string, pageviews bigint, processing_date date")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_raw(hot.unionByName(cold), f"{scratch}/raw")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_files = [f for f in os.listdir(local_path(f"{scratch}/raw/processing_date=2024-01-15")) if f.endswith(".json")]
    cold_files = [f for f in os.listdir(local_path(f"{scratch}/raw/processing_date=2024-01-16")) if f.endswith(".json")]
    assert len(hot_files) > 1 and len(cold_files) == 1
    assert read_raw(spark, f"{scratch}/raw").count() == 30001


def test_batch_job_command_line(spark, scratch):
    """J1/J3 through the spark-submit entry point's argument parser."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(12)]
    rows = [(d.isoformat(), "en.wikipedia", 100 + i) for i, d in enumerate(days)]
    raw = spark.createDataFrame(rows, "date string, domain string, pageviews bigint")
    run_dates = F.array(*[F.lit(dt.date(2024, 1, 8) + dt.timedelta(i)) for i in range(3)])
    write_raw(raw.select("*", F.explode(run_dates).alias("processing_date")), f"{scratch}/raw")
    args = ["--raw-root", f"{scratch}/raw", "--trusted-root", f"{scratch}/trusted"]
    jobs.run_cli(["trusted", "--date", "2024-01-08", *args], spark)
    assert spark.read.parquet(f"{scratch}/trusted").count() == 7
    jobs.run_cli(["backfill", "--start", "2024-01-08", "--end", "2024-01-10", *args], spark)
    out = spark.read.parquet(f"{scratch}/trusted")
    assert out.count() == 21
    assert out.where(F.col("pageview_date") >= F.col("processing_date")).count() == 0


def test_replies_are_bounded_in_size(spark):
    """Replies hold about entries_per_reply domains, whatever a day holds."""
    from tidemark.plans.driver_tables import pageview_replies

    daily = spark.range(0, 5000).select(
        F.lit(dt.date(2024, 1, 1)).alias("day"),
        F.concat(F.lit("site"), F.col("id").cast("string")).alias("domain"),
        F.col("id").alias("pageviews"),
    )
    replies = pageview_replies(daily, entries_per_reply=500)
    parsed = replies.select(F.from_json("reply", "map<string,map<string,bigint>>").alias("r"))
    sizes = [r.n for r in parsed.select(F.size(F.map_values("r")[0]).alias("n")).collect()]
    assert sum(sizes) == 5000 and len(sizes) == 10
    assert max(sizes) < 2 * 500
    assert flatten_replies(replies).count() == 5000


def test_trusted_job_reads_json_array_files(spark, scratch):
    """The trusted job over raw files written as one JSON array per run."""
    folder = local_path(f"{scratch}/raw/processing_date=2024-01-15")
    os.makedirs(folder)
    with open(f"{folder}/data.json", "w") as fh:
        json.dump([{"date": d, "domain": dom, "pageviews": v} for d, dom, v in _raw_rows()], fh, indent=4)
    jobs.run_cli(["trusted", "--date", "2024-01-15", "--multiline",
                  "--raw-root", f"{scratch}/raw", "--trusted-root", f"{scratch}/trusted"], spark)
    assert spark.read.parquet(f"{scratch}/trusted").count() == 5


def test_daily_step_command_line(spark, scratch):
    """J2 from the command line: replies -> raw -> trusted for one run."""
    folder = local_path(f"{scratch}/replies")
    os.makedirs(folder)
    with open(f"{folder}/part.json", "w") as fh:
        fh.write(json.dumps({"2024-01-14": {"en.wikipedia": 3, "fr.wikipedia": 2}}) + "\n")
        fh.write(json.dumps({"2024-01-15": {"en.wikipedia": 9}, "2024-01-01": {"en.wikipedia": 1}}) + "\n")
    jobs.run_cli(["daily", "--date", "2024-01-15", "--replies", f"{scratch}/replies",
                  "--raw-root", f"{scratch}/raw", "--trusted-root", f"{scratch}/trusted"], spark)
    raw = read_raw(spark, f"{scratch}/raw")
    assert raw.count() == 4
    out = sorted((r.domain, r.pageviews) for r in spark.read.parquet(f"{scratch}/trusted").collect())
    assert out == [("en.wikipedia", 3), ("fr.wikipedia", 2)]


def test_batch_cli_rejects_missing_arguments(spark, scratch):
    with pytest.raises(SystemExit):
        jobs.run_cli(["backfill", "--start", "2024-01-01", "--raw-root", "r", "--trusted-root", "t"], spark)
    with pytest.raises(SystemExit):
        jobs.run_cli(["daily", "--date", "2024-01-15", "--raw-root", "r", "--trusted-root", "t"], spark)
