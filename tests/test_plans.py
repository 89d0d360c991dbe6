"""Plan shape guards for the scale properties the README claims."""

import re

import pytest

import __spark_entry__ as entry

from plans import plan_text

SF = "/root/testdata/sf0.001"
STREAMING = {"stream_replay_closed", "stream_fanout_index", "stream_day_segments", "stream_edit_normalise"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - STREAMING))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = plan_text(entry.queries()[name](spark, SF), "simple")
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["edit_normalise", "edit_parse_skip_bad", "cross_source_daily"])
def test_raw_events_parsed_once(spark, name):
    """One parse by the declared schema; the parse as a variant stands once in
    the plan, under the condition that the first one left something open."""
    plan = plan_text(entry.queries()[name](spark, SF), "simple")
    assert plan.count("from_json(") == 1
    assert plan.lower().replace("_", "").count("parsejson(") == 1
    assert re.search(r"CASE WHEN NOT _whole#\d+ THEN [^,]*parse_?json\(", plan, re.I)


def test_backfill_bound_reaches_the_scan(spark):
    plan = plan_text(entry.queries()["trusted_backfill"](spark, SF), "simple")
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "GreaterThanOrEqual(ts," in scan and "LessThan(ts," in scan


def test_allowlist_is_pushed_into_the_scan(spark):
    plan = plan_text(entry.queries()["domain_allowlist"](spark, SF), "simple")
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "In(event_type, [click,purchase,view])" in scan


def test_first_n_has_no_single_merge_task(spark):
    plan = plan_text(entry.queries()["first_n_events"](spark, SF), "simple")
    assert "TakeOrderedAndProject" not in plan and "SinglePartition" not in plan


def test_time_range_read_prunes_day_folders(spark):
    plan = plan_text(entry.queries()["segments_time_range"](spark, SF), "simple")
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(segment_day" in scan and "2024-01-08" in scan and "2024-01-14" in scan and "2024-01-15" not in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
