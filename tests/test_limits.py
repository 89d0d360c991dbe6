"""The first n by key equals a plain sort, for any n, type and ties."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.limits import first_n
from plans import plan_text

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [10, 1000, 20_000])
def test_equals_a_plain_sort(spark, n):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id")
    want = sorted(r.event_id for r in ev.collect())[:n]
    got = first_n(ev, n, "event_id")
    assert [r.event_id for r in got.collect()] == want
    assert "TakeOrderedAndProject" not in plan_text(got, "simple")


def test_ties_and_nulls(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(
        "event_id", F.when(F.col("event_id") % 50 == 0, None).otherwise(F.col("user_id")).alias("k")
    )
    rows = sorted((r.k is None, r.k or 0) for r in ev.collect())
    for n in (2500, 9805):  # inside a tie; beyond the keyed rows
        got = first_n(ev, n, "k").collect()
        assert [(r.k is None, r.k or 0) for r in got] == rows[:n]
        assert len({r.event_id for r in got}) == n


@pytest.mark.parametrize("kind,keys", [
    ("string", ["", "a", "aa", "abcdefgh1", "abcdefgh2", "\u00e9", None]),
    ("double", [0.1, 0.1, -3.5, 1e300, None, 7.0]),
    ("long", [2**62, -(2**62), 2**62 + 1, 0, None, 0]),
])
def test_types(spark, kind, keys):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"k {kind}, i int")
    want = sorted(keys, key=lambda k: (k is None, 0 if k is None else k.encode() if kind == "string" else k))
    for n in range(len(keys) + 2):
        assert [r.k for r in first_n(df, n, "k").collect()] == want[:n]


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x")] * 90 + [(0, "y")], "k long, v string")
    assert [r.k for r in first_n(df, 41, "k").collect()] == [0] + [1] * 40
