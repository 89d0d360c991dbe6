"""Q5 with D8: stream host names meet pageview project names."""

import datetime as dt

from tidemark.operators import crosssource


def test_host_and_project_names_join_by_day(spark):
    t = lambda h, m, s: dt.datetime(2024, 1, 10, h, m, s)
    counts = spark.createDataFrame(
        [
            ("en.wikipedia.org", t(0, 0, 10), 3),
            ("en.wikipedia.org", t(23, 59, 50), 2),   # window ending 2024-01-10 23:59:50
            ("en.wikipedia.org", dt.datetime(2024, 1, 11), 4),  # ends at midnight: still Jan 10
            ("WWW.Commons.Wikimedia.org", t(12, 0, 0), 1),
        ],
        "domain string, ten_second_window timestamp, count_actions bigint",
    )
    trusted = spark.createDataFrame(
        [
            ("en.wikipedia", 100, dt.date(2024, 1, 10), dt.date(2024, 1, 11)),
            ("en.wikipedia", 100, dt.date(2024, 1, 10), dt.date(2024, 1, 12)),  # same day, later run
            ("commons.wikimedia", 50, dt.date(2024, 1, 10), dt.date(2024, 1, 11)),
            ("fr.wikipedia", 7, dt.date(2024, 1, 10), dt.date(2024, 1, 11)),
        ],
        "domain string, pageviews bigint, pageview_date date, processing_date date",
    )
    out = crosssource.cross_source_daily(crosssource.daily_edits(counts), crosssource.daily_pageviews(trusted))
    got = {(r.domain, r.day): (r.edits, r.pageviews, r.edit_ratio) for r in out.collect()}
    assert got == {
        ("en.wikipedia", dt.date(2024, 1, 10)): (9, 100, 0.09),
        ("commons.wikimedia", dt.date(2024, 1, 10)): (1, 50, 0.02),
        ("fr.wikipedia", dt.date(2024, 1, 10)): (0, 7, 0.0),
    }
