
import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.pageviews import flatten_replies, trusted_transform

_day = st.dates(min_value=dt.date(2023, 12, 1), max_value=dt.date(2024, 2, 1))
_views = st.one_of(st.none(), st.integers(min_value=0, max_value=10**9))
_inner = st.dictionaries(st.sampled_from(["a.site", "b.site", "c.site", "d.site"]), _views, max_size=4)
_reply = st.dictionaries(_day.map(lambda d: d.isoformat()), _inner, max_size=5)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(replies=st.lists(_reply, min_size=1, max_size=6))
def test_flatten_yields_one_row_per_inner_entry(spark, replies):
    df = spark.createDataFrame([(json.dumps(r),) for r in replies], "reply string")
    out = flatten_replies(df).collect()
    assert len(out) == sum(len(inner) for r in replies for inner in r.values())
    key = lambda t: (t[0], t[1], t[2] is None, t[2] or 0)
    want = sorted(((d, k, v) for r in replies for d, inner in r.items() for k, v in inner.items()), key=key)
    assert sorted(((r.date, r.domain, r.pageviews) for r in out), key=key) == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(_day.map(lambda d: d.isoformat()), st.just("bad"), st.none()),
                               _views), min_size=1, max_size=30),
       ds=_day)
def test_trusted_rows_lie_in_window(spark, rows, ds):
    raw = spark.createDataFrame([(d, "a.site", v) for d, v in rows], "date string, domain string, pageviews bigint")
    out = trusted_transform(raw, ds).collect()
    lo = ds - dt.timedelta(days=7)
    assert all(lo <= r.pageview_date < ds and r.processing_date == ds for r in out)
    expected = sum(1 for d, _ in rows if d not in (None, "bad") and lo <= dt.date.fromisoformat(d) < ds)
    assert len(out) == expected


_events = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(min_value=0, max_value=10**6)),
    min_size=1, max_size=40,
)


@SETTINGS
@given(events=_events)
def test_tumbling_count_matches_brute_force(spark, events):
    from tidemark.operators.windows import tumbling_count

    base = dt.datetime(2024, 1, 1)
    rows = [(d, base + dt.timedelta(milliseconds=ms)) for d, ms in events]
    df = spark.createDataFrame(rows, "domain string, createTime timestamp_ntz")
    got = {(r.domain, r.ten_second_window): r.count_actions for r in tumbling_count(df).collect()}
    want = {}
    for d, ts in rows:
        end = base + dt.timedelta(seconds=((ts - base).total_seconds() // 10 + 1) * 10)
        want[(d, end)] = want.get((d, end), 0) + (1 if d is not None else 0)
    assert got == want


@SETTINGS
@given(days=st.lists(_day, min_size=1, max_size=20, unique=True), start=_day,
       span=st.integers(min_value=0, max_value=12))
def test_backfill_matches_definition(spark, days, start, span):
    from tidemark.operators.pageviews import explode_run_dates

    end = start + dt.timedelta(days=span)
    daily = spark.createDataFrame([(d, "a.site", i) for i, d in enumerate(days)],
                                  "pageview_date date, domain string, pageviews bigint")
    got = sorted((r.pageview_date, r.processing_date) for r in explode_run_dates(daily, start, end).collect())
    want = sorted(
        (d, start + dt.timedelta(days=k))
        for k in range(span + 1)
        for d in days
        if start + dt.timedelta(days=k) - dt.timedelta(days=7) <= d < start + dt.timedelta(days=k)
    )
    assert got == want
