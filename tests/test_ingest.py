"""Stored sketches, chunk replacement, bulk writer, budget, ledger,
compaction and live lookup."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paths import local_path
from tidemark import storage
from tidemark.operators import sketches
from tidemark.plans.ledger import RunLedger, RunsFailed, catch_up
from tidemark.schemas import DAY_SEGMENT
from tidemark.sinks import bulk, compaction
from tidemark.sinks.partitions import write_partitions
from tidemark.sinks.segments import replace_time_chunk, write_segments
from tidemark.sinks.topics import to_text_frames, write_topic
from tidemark.sources.topics import Topic, read_topic
from tidemark.streaming import normaliser_stream as ns
from tidemark.streaming import window_stream as ws
from tidemark.streaming.budget import Budget
from tidemark.streaming.live_lookup import LookupVersions, start_enriched

EVENTS = "/root/testdata/sf0.01/events.parquet"


# --- storage ---------------------------------------------------------------

def test_small_files(spark, scratch):
    assert storage.names(spark, f"{scratch}/no") == [] and not storage.exists(spark, f"{scratch}/no")
    storage.write_text(spark, f"{scratch}/f/a.json", "one")
    storage.write_text(spark, f"{scratch}/f/a.json", "zwei é")
    assert storage.read_text(spark, f"{scratch}/f/a.json") == "zwei é" and storage.names(spark, f"{scratch}/f") == ["a.json"]
    storage.remove(spark, f"{scratch}/f")
    assert not storage.exists(spark, f"{scratch}/f/a.json")


# --- C1, C2: sketches --------------------------------------------------------

def ranks_off(values, found, p):
    """How far the rank of an estimated quantile is from the wanted one."""
    low, high = sum(v < found for v in values), sum(v <= found for v in values)
    return max(0.0, low - p * len(values), p * len(values) - high) / len(values)


def test_stored_quantile_sketches_merge(spark, scratch):
    ev = spark.read.parquet(EVENTS).select(F.col("event_type").alias("domain"), F.to_date("ts").alias("day"), "value")
    sketches.kll_sketches(ev, ["domain", "day"], "value").write.parquet(f"{scratch}/daily")
    daily = spark.read.parquet(f"{scratch}/daily")
    for group in (["domain"], []):
        values = {}
        for r in ev.where("value IS NOT NULL").collect():
            values.setdefault(tuple(r[g] for g in group), []).append(r.value)
        rows = sketches.kll_quantiles(sketches.merge_kll(daily, group), (0.01, 0.5, 0.999)).collect()
        assert len(rows) == len(values)
        for r in rows:
            own = values[tuple(r[g] for g in group)]
            assert r.n_values == len(own)
            assert all(ranks_off(own, r[n], p) <= sketches.kll_rank_bound() + 1 / len(own) for n, p in (("p1", 0.01), ("p50", 0.5), ("p99_9", 0.999)))


def test_quantile_sketches_odd_input(spark):
    rows = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None), (None, 2.0)], "g string, v double")
    got = {r.g: (r.n_values, r.p50) for r in sketches.kll_quantiles(sketches.kll_sketches(rows, ["g"], "v"), (0.5,)).collect()}
    assert got == {"b": (1, 1.0), None: (1, 2.0)}  # a group without values has no sketch
    whole = sketches.kll_sketches(spark.createDataFrame([(float(i),) for i in range(101)], "v double"), [], "v")
    assert abs(whole.select(sketches.kll_rank("sketch", F.lit(50.0))).first()[0] - 0.5) < 0.02
    assert sketches.kll_sketches(rows.limit(0), ["g"], "v").collect() == []


def test_fixed_histogram_counts_and_quantiles(spark):
    values = [-1.0, 0.0, 0.5, 9.999, 10.0, 55.0, 99.99, 100.0, 1e9, float("nan"), None, None]
    rows = spark.createDataFrame([("a", k % 2, v) for k, v in enumerate(values)] + [("empty", 0, None)], "g string, d int, v double")
    fine = sketches.fixed_histograms(rows, ["g", "d"], "v", 0, 100, 10)
    merged = {r.g: r for r in sketches.merge_fixed(fine, ["g"], 10).withColumn("q", sketches.fixed_quantile("counts", 0.5, 0, 100, 10)).collect()}
    assert merged["a"].counts == [1, 3, 1, 0, 0, 0, 1, 0, 0, 0, 1, 3] and merged["a"].n_null == 2
    assert merged["empty"].counts == [0] * 12 and merged["empty"].n_null == 1 and merged["empty"].q is None
    direct = sketches.fixed_histograms(rows, ["g"], "v", 0, 100, 10)
    assert {r.g: (r.counts, r.n_null) for r in direct.collect()} == {g: (r.counts, r.n_null) for g, r in merged.items()}
    even = spark.range(1000).select((F.col("id") / 10).alias("v"))
    one = sketches.fixed_histograms(even, [], "v", 0, 100, 20)
    got = one.select(*[sketches.fixed_quantile("counts", p, 0, 100, 20).alias(str(p)) for p in (0.0, 0.25, 0.5, 1.0)]).first()
    assert all(math.isclose(x, 100 * p, abs_tol=0.2) for x, p in zip(got, (0.0, 0.25, 0.5, 1.0)))


# --- writes that answer for partitions, and C5 ---------------------------------

def segments(spark, rows):
    """(day of January, domain, count)"""
    at = F.make_timestamp(F.lit(2024), F.lit(1), F.col("d"), F.lit(12), F.lit(0), F.lit(0))
    return spark.createDataFrame(rows, "d int, domain string, n long").select(
        at.alias("__time"), F.col("n").alias("count_actions"), "domain", F.lit(0).cast("long").alias("kafka_timestamp"), F.to_date(at).alias("segment_day")
    )


def table(spark, root):
    return sorted((r.segment_day.day, r.domain, r.count_actions) for r in spark.read.schema(DAY_SEGMENT).parquet(root).collect())


def test_input_is_computed_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = segments(spark, [(1, "a", 1), (2, "b", 2)])
    counted = rows.mapInPandas(count, rows.schema)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    write_partitions(segments(spark, [(3, "old", 9), (4, "old", 9)]), f"{scratch}/t", "parquet", "segment_day")
    write_partitions(counted, f"{scratch}/t", "parquet", "segment_day", answers_for=days)
    assert seen.value == 2 and table(spark, f"{scratch}/t") == [(1, "a", 1), (2, "b", 2), (4, "old", 9)]


def test_replace_time_chunk(spark, scratch):
    root = f"{scratch}/day"
    write_segments(segments(spark, [(d, x, d) for d in range(1, 8) for x in "abc"]), root)
    replace_time_chunk(segments(spark, [(3, "new", 30), (5, "new", 50)]), root, dt.date(2024, 1, 3), dt.date(2024, 1, 6))
    want = [(d, x, d) for d in (1, 2, 6, 7) for x in "abc"] + [(3, "new", 30), (5, "new", 50)]
    assert table(spark, root) == sorted(want)  # the 4th came out empty, its neighbours are untouched
    with pytest.raises(Exception, match="row outside the chunk"):
        replace_time_chunk(segments(spark, [(5, "x", 1), (6, "x", 1)]), root, dt.date(2024, 1, 3), dt.date(2024, 1, 6))
    with pytest.raises(ValueError):
        replace_time_chunk(segments(spark, []), root, dt.date(2024, 1, 3), dt.date(2024, 1, 3))
    assert table(spark, root) == sorted(want)  # a failed replace changes nothing
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")  # a user's own setting
    try:
        replace_time_chunk(segments(spark, []), root, dt.date(2024, 1, 3), dt.date(2024, 1, 6))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert table(spark, root) == sorted(x for x in want if x[1] != "new")


def test_replaced_chunk_is_clustered(spark, scratch):
    """Each file holds a narrow range of the clustering column, by its own
    Parquet statistics, so that a filter on it skips the other files."""
    import pathlib

    import pyarrow.parquet as pq

    root = f"{scratch}/clustered"
    rows = segments(spark, [(1 + i % 2, f"domain{i % 97:02}", i) for i in range(20_000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, as with much data
    try:
        replace_time_chunk(rows, root, dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(pathlib.Path(local_path(root)).glob("segment_day=2024-01-01/*.parquet"))
    ranges = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("domain")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    ranges.sort()
    assert len(ranges) >= 3 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(a <= "domain50" <= b for a, b in ranges) <= 2


# --- K4: bulk writer -----------------------------------------------------------

class Flaky:
    """A transport that fails some sends."""

    def __init__(self, failures=0, sizes=None):
        self.failures, self.sent = failures, []

    def send(self, actions):
        if self.failures:
            self.failures -= 1
            raise OSError("busy")
        self.sent.append([a.id for a in actions])


def test_bulks_are_cut_by_actions_bytes_and_time():
    now = [0.0]
    t = Flaky()
    b = bulk.Bulks(t, max_actions=3, max_bytes=100, interval_ms=1000, clock=lambda: now[0])
    for i in range(7):
        b.add(bulk.Action(str(i), "x"))
    assert [len(x) for x in t.sent] == [3, 3]
    b.add(bulk.Action("big", "y" * 98))  # would pass the bytes: what is held goes first
    assert [len(x) for x in t.sent] == [3, 3, 1]
    now[0] = 5.0
    b.add(bulk.Action("s", "z"))
    assert t.sent[3:] == [["big"]] and len(b.held) == 1
    now[0] = 6.5
    b.add(bulk.Action("u", "z"))  # a second since the bulk's first document
    assert t.sent[4] == ["s", "u"] and b.sent == 10 and b.bulks == 5
    b.flush()
    assert b.bulks == 5  # nothing held, nothing sent


def test_sends_are_retried_with_back_off():
    waits = []
    t = Flaky(failures=2)
    b = bulk.Bulks(t, max_actions=1, backoff_ms=1000, sleep=waits.append)
    b.add(bulk.Action("a", "x"))
    assert t.sent == [["a"]] and waits == [1.0, 1.0] and b.retries == 2
    b = bulk.Bulks(Flaky(failures=99), max_actions=1, max_retries=3, sleep=waits.append)
    with pytest.raises(OSError):
        b.add(bulk.Action("a", "x"))
    assert len(waits) == 5


def test_http_transport_requests_and_item_errors():
    asked = []

    def answer(request):
        asked.append(request)
        return json.dumps({"errors": len(asked) > 1, "items": [{"index": {"error": {"type": "full"}}}]}).encode()

    t = bulk.HttpTransport("http://host:9200/", "wikipedia_window_1", "u", "p", send=answer)
    t.send([bulk.Action("i$1", '{"a":1}'), bulk.Action("i2", '{"a":2}')])
    assert asked[0].full_url == "http://host:9200/_bulk" and asked[0].get_method() == "POST"
    lines = asked[0].data.decode().splitlines()
    assert json.loads(lines[0]) == {"index": {"_index": "wikipedia_window_1", "_id": "i$1"}} and lines[1] == '{"a":1}' and len(lines) == 4
    with pytest.raises(OSError, match="documents failed"):
        t.send([bulk.Action("x", "{}")])


DOC = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def docs(spark, ids, n=0):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1, 12, 0, 0, 5000), n, "é\n\"") for i in ids], "doc_id string, at timestamp, n long, s string")


def test_bulk_write_and_read(spark, scratch):
    ids = [f"d{i}" for i in range(100)]
    bulk.write_bulk(docs(spark, ids).coalesce(1), scratch)
    sizes = [len(x) for x in (f.read_text().splitlines() for f in __import__("pathlib").Path(local_path(scratch)).glob("bulks/*.json"))]
    assert max(sizes) == bulk.MAX_ACTIONS and sum(sizes) == 100
    bulk.write_bulk(docs(spark, ids[:40], 7), scratch)  # again: the last one counts
    got = {r["_id"]: r for r in bulk.read_bulks(spark, scratch, DOC).collect()}
    assert set(got) == set(ids) and all(got[i].n == (7 if k < 40 else 0) and got[i].s == "é\n\"" for k, i in enumerate(ids))
    assert {r.at for r in got.values()} == {r.at for r in docs(spark, ids[:1]).collect()}
    commits = bulk.read_commits(spark, scratch).orderBy("documents").collect()
    assert [(r.state, r.documents) for r in commits] == [("committed", 40), ("committed", 100)]


def test_bulk_write_again_after_a_failed_task(spark, scratch):
    good = docs(spark, [f"d{i}" for i in range(200)]).repartition(4)
    bad = docs(spark, [None])
    with pytest.raises(Exception, match="without an id"):
        bulk.write_bulk(good.unionByName(bad), scratch)
    bulk.write_bulk(good, scratch)
    ids = [r["_id"] for r in bulk.read_bulks(spark, scratch, DOC).collect()]
    assert len(ids) == len(set(ids)) == 200
    assert sorted(r.state for r in bulk.read_commits(spark, scratch).collect()) == ["aborted", "committed"]


def test_bulk_stream(spark, scratch):
    for k in range(2):
        docs(spark, [f"d{i}" for i in range(50 * k, 50 * k + 60)], k).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(docs(spark, []).schema).parquet(f"{scratch}/in")
        ws.drain(bulk.write_bulk_stream(stream, f"{scratch}/index", f"{scratch}/ckpt"))
    got = {r["_id"]: r.n for r in bulk.read_bulks(spark, f"{scratch}/index", DOC).collect()}
    assert len(got) == 110 and got["d55"] == 1
    assert sorted(r.batch for r in bulk.read_commits(spark, f"{scratch}/index").collect()) == [0, 1]


def test_bulk_options_are_checked(spark, scratch):
    bulk.register(spark)
    with pytest.raises(Exception, match="target"):
        docs(spark, ["a"]).write.format(bulk.FORMAT).mode("append").option("id", "doc_id").save()
    with pytest.raises(Exception, match="only appends"):
        docs(spark, ["a"]).write.format(bulk.FORMAT).mode("overwrite").options(target=scratch, id="doc_id").save()


# --- G2, K5: budget of a stream ---------------------------------------------------

def edits(first, n):
    return [
        (f'{{"id": {i}, "type": "edit", "meta": {{"domain": "d"}}, "namespace": 0, "title": "t", "timestamp": {1704067200 + i}, "user": "u", "bot": false}}',)
        for i in range(first, first + n)
    ]


@pytest.mark.parametrize("crash", ["before the record", "after the record"])
def test_crash_between_publish_and_commit(spark, scratch, monkeypatch, crash):
    """The second batch publishes, then the query dies before its checkpoint
    commit; the restarted query repeats the batch: N distinct events."""
    raw, events = Topic("raw", path=f"{scratch}/raw"), Topic("events", path=f"{scratch}/events")

    def add(first):
        write_topic(to_text_frames(spark.createDataFrame(edits(first, 30), "value string"), raw), raw)

    def run():
        ws.drain(ns.start_normaliser(ns.raw_topic_stream(spark, raw), events, f"{scratch}/ckpt", max_events=50))

    add(0)
    run()
    add(30)
    record = Budget.record

    def dies(self, spark, batch, published):
        if crash == "after the record":
            record(self, spark, batch, published)
        raise RuntimeError("killed")

    monkeypatch.setattr(Budget, "record", dies)
    with pytest.raises(Exception, match="killed"):
        run()
    monkeypatch.setattr(Budget, "record", record)
    assert read_topic(spark, events).count() == 50  # published, but not committed
    run()
    add(60)
    run()
    ids = sorted(json.loads(bytes(r.value))["id"] for r in read_topic(spark, events).collect())
    assert ids == list(range(50)) and Budget(f"{scratch}/ckpt", 50).spent(spark)


# --- J3, J4: ledger ------------------------------------------------------------

def test_catch_up_skips_retries_and_resumes(spark, scratch):
    ledger = RunLedger(spark, f"{scratch}/ledger")
    calls, broken = [], {dt.date(2024, 1, 3): 99, dt.date(2024, 1, 4): 1}

    def work(first, last):
        assert first == last
        calls.append(first.day)
        if broken.get(first, 0) > 0:
            broken[first] -= 1
            raise OSError("no answer")

    with pytest.raises(RunsFailed, match="2024-01-03"):
        catch_up(ledger, "2024-01-01", "2024-01-05", work)
    assert calls == [1, 2, 3, 3, 3, 4, 4, 5]  # in order; two more tries
    assert [(r.first[-2:], r.state, r.attempts) for r in ledger.entries()] == [
        ("01", "done", 1), ("02", "done", 1), ("03", "failed", 3), ("04", "done", 2), ("05", "done", 1)]
    assert "no answer" in ledger.entries()[2].error
    broken.clear()
    calls.clear()
    assert [r.first for r in catch_up(ledger, "2024-01-01", "2024-01-06", work)] == ["2024-01-03", "2024-01-06"] and calls == [3, 6]
    assert catch_up(ledger, "2024-01-01", "2024-01-06", work) == []


def test_catch_up_that_was_killed_repeats_the_open_run(spark, scratch):
    ledger = RunLedger(spark, f"{scratch}/ledger")

    def dies(first, last):
        if first.day == 2:
            raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        catch_up(ledger, "2024-01-01", "2024-01-03", dies)
    assert [(r.first, r.state) for r in ledger.entries()] == [("2024-01-01", "done"), ("2024-01-02", "running")]
    done = []
    catch_up(ledger, "2024-01-01", "2024-01-03", lambda a, b: done.append(a.day))
    assert done == [2, 3]


# --- K6: compaction --------------------------------------------------------------

def live(spark, root, **days):
    return sorted((r.segment_day.day, r.domain, r.count_actions) for r in compaction.read_compacted(spark, root, **days).collect())


def test_compaction_swaps_versions(spark, scratch):
    root, want = f"{scratch}/table", []
    assert compaction.compact(spark, root) == 0 and live(spark, root) == []
    for batch in range(4):
        rows = [(1 + batch % 3, f"b{batch}", i) for i in range(5)] + [(9, "late", batch)]
        compaction.add_batch(segments(spark, rows).repartition(4), root, batch)
        want += rows
    assert live(spark, root) == sorted(want)
    reader = compaction.read_compacted(spark, root)  # planned before the compaction, read after it
    assert compaction.compact(spark, root) == 1 and compaction.compact(spark, root) == 1
    assert live(spark, root) == sorted(want)
    assert sorted((r.segment_day.day, r.domain, r.count_actions) for r in reader.collect()) == sorted(want)
    per_day = [len(storage.names(spark, f"{root}/compacted/1/segment=2024-01-0{d}")) for d in (1, 2, 3, 9)]
    assert per_day == [1, 1, 1, 1]
    more = [(2, "new", 1)]
    compaction.add_batch(segments(spark, more), root, 4)
    assert live(spark, root) == sorted(want + more) and live(spark, root, version=1) == sorted(want)
    assert compaction.compact(spark, root) == 2
    assert compaction.manifest(spark, root)["days"] == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1, "2024-01-09": 1}
    assert live(spark, root, start=dt.date(2024, 1, 2), end=dt.date(2024, 1, 3)) == sorted(x for x in want + more if x[0] == 2)
    compaction.vacuum(spark, root, keep=1)
    assert live(spark, root) == sorted(want + more) and storage.names(spark, f"{root}/stream") == []
    assert storage.names(spark, f"{root}/compacted/1") == ["segment=2024-01-01", "segment=2024-01-03", "segment=2024-01-09"]


def test_compaction_leaves_out_what_is_not_whole(spark, scratch):
    """A batch without its success marker, and a compaction that died before
    its manifest, are not there for readers."""
    root = f"{scratch}/table"
    compaction.add_batch(segments(spark, [(1, "a", 1)]), root, 0)
    compaction.add_batch(segments(spark, [(1, "broken", 1)]), root, 1)
    storage.remove(spark, f"{root}/stream/{1:012d}/_SUCCESS")
    segments(spark, [(1, "half", 1)]).withColumn("segment", F.col("segment_day")).write.partitionBy("segment").parquet(f"{root}/compacted/1")
    assert live(spark, root) == [(1, "a", 1)]
    compaction.compact(spark, root)
    assert live(spark, root) == [(1, "a", 1)]


def test_compacted_stream(spark, scratch):
    for k in range(2):
        segments(spark, [(1, "x", k)]).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(segments(spark, []).schema).parquet(f"{scratch}/in")
        ws.drain(compaction.write_batches(stream, f"{scratch}/t", f"{scratch}/ckpt"))
        compaction.compact(spark, f"{scratch}/t")
    assert live(spark, f"{scratch}/t") == [(1, "x", 0), (1, "x", 1)]


# --- C4: live lookup ----------------------------------------------------------------

def test_lookup_changes_between_batches(spark, scratch):
    versions = LookupVersions(spark, f"{scratch}/lookup")
    schema = "k long, v string"

    def run(key, value):
        if value is not None:
            versions.publish(spark.createDataFrame([(1, value)], schema))
        spark.createDataFrame([(key,)], "k long").write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema("k long").parquet(f"{scratch}/in")
        ws.drain(start_enriched(stream, f"{scratch}/lookup", "k", f"{scratch}/out", f"{scratch}/ckpt"))

    with pytest.raises(Exception, match="no version of the lookup"):
        run(1, None)
    versions.publish(spark.createDataFrame([(1, "first")], schema))
    run(2, None)
    run(1, "second")
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{scratch}/out").collect()
    assert sorted((r.k, r.v or "") for r in rows) == [(1, "first"), (1, "second"), (2, "")]
    versions.vacuum(keep=1)
    assert versions.versions() == [2]


def test_replayed_batch_keeps_its_lookup(spark, scratch):
    versions = LookupVersions(spark, f"{scratch}/lookup")
    versions.publish(spark.createDataFrame([(1, "old")], "k long, v string"))
    versions.publish(spark.createDataFrame([(1, "new")], "k long, v string"))
    storage.write_text(spark, f"{scratch}/ckpt/lookup/0.json", '{"version": 1}')  # the batch began, then died
    spark.createDataFrame([(1,)], "k long").write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema("k long").parquet(f"{scratch}/in")
    ws.drain(start_enriched(stream, f"{scratch}/lookup", "k", f"{scratch}/out", f"{scratch}/ckpt"))
    assert [r.v for r in spark.read.option("recursiveFileLookup", True).parquet(f"{scratch}/out").collect()] == ["old"]


# --- Q5 as a stream --------------------------------------------------------------------

def test_cross_source_stream_waits_for_the_slower_source(spark, scratch):
    from tidemark.streaming.cross_source_stream import cross_source_stream, start_cross_source

    def at(day, hour=12):
        return dt.datetime(2024, 1, day, hour)

    def run(edits, views):
        spark.createDataFrame(edits, "domain string, createTime timestamp").write.mode("append").parquet(f"{scratch}/edits")
        spark.createDataFrame(views, "domain string, reported timestamp, pageviews long").write.mode("append").parquet(f"{scratch}/views")
        joined = cross_source_stream(
            spark.readStream.schema("domain string, createTime timestamp").parquet(f"{scratch}/edits"),
            spark.readStream.schema("domain string, reported timestamp, pageviews long").parquet(f"{scratch}/views"),
        )
        with ws.state_partitions(spark, 4):
            ws.drain(start_cross_source(joined, f"{scratch}/out", f"{scratch}/ckpt"))
        rows = spark.read.schema("domain string, day date, edits long, pageviews long, edit_ratio double").parquet(f"{scratch}/out").collect()
        return sorted((r.day.day, r.domain, r.edits, r.pageviews) for r in rows)

    first = run([("en.wikipedia.org", at(1)), ("en.wikipedia.org", at(1, 13)), ("de.wikipedia.org", at(1)), ("x.org", at(4))], [("en.wikipedia", at(1), 10), ("fr.wikipedia", at(1), 5)])
    assert first == []  # the pageviews have not passed the first day
    second = run([("x.org", at(5))], [("en.wikipedia", at(2, 23), 20), ("late", at(3, 1), 1)])
    assert second == [(1, "de.wikipedia", 1, None), (1, "en.wikipedia", 2, 10), (1, "fr.wikipedia", 0, 5), (2, "en.wikipedia", 0, 20)]
    third = run([("y.org", at(9)), ("en.wikipedia.org", at(1, 20))], [("z", at(9), 1)])  # an edit of a closed day is late
    assert third[:4] == second and [x for x in third if x[0] < 3] == second


# --- T5: late rows to a side table ------------------------------------------------------

def test_late_rows_are_kept_beside_the_counts(spark, scratch):
    from tidemark.streaming.late_rows import read_counts, read_late, start_counts_and_late

    def at(second, minute=0):
        return dt.datetime(2024, 1, 1, 12, minute, second)

    def run(rows):
        spark.createDataFrame(rows, "domain string, createTime timestamp").write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema("domain string, createTime timestamp").parquet(f"{scratch}/in")
        with ws.state_partitions(spark, 2):
            ws.drain(start_counts_and_late(stream, f"{scratch}/counts", f"{scratch}/late", f"{scratch}/ckpt"))
        counts = sorted((r.domain or "", r.ten_second_window.second, r.count_actions) for r in read_counts(spark, f"{scratch}/counts").collect())
        return counts, sorted((r.domain, r.createTime.second) for r in read_late(spark, f"{scratch}/late").collect())

    assert run([("a", at(1)), ("a", at(9)), ("a", at(10)), ("b", at(3)), (None, at(4)), ("a", at(24))]) == ([("", 10, 0), ("a", 10, 2), ("b", 10, 1)], [])
    # watermark 12:00:19: the first window is closed, the second one open
    second = run([("a", at(2)), ("b", at(5)), ("a", at(11)), ("c", at(40))])
    assert second == ([("", 10, 0), ("a", 10, 2), ("a", 20, 2), ("a", 30, 1), ("b", 10, 1)], [("a", 2), ("b", 5)])
    third = run([("a", at(12)), ("c", at(0, 1))])
    assert third == (sorted(second[0] + [("c", 50, 1)]), [("a", 2), ("a", 12), ("b", 5)])
    assert sum(n for _, _, n in third[0]) + len(third[1]) + 1 + 1 == 12  # one open window, one event without a domain


# --- command lines ------------------------------------------------------------------------

def test_catch_up_and_compact_command_lines(spark, scratch):
    from tidemark.plans import jobs
    from tidemark.sinks.layers import write_raw
    from tidemark.sinks.topics import to_frames
    from tidemark.streaming import jobs as stream_jobs

    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    raw = spark.createDataFrame([(str(d), "en", d.day, r) for r in days for d in days if d < r], "date string, domain string, pageviews long, processing_date date")
    write_raw(raw, f"{scratch}/raw")
    args = ["catchup", "--start", "2024-01-02", "--end", "2024-01-10", "--raw-root", f"{scratch}/raw", "--trusted-root", f"{scratch}/trusted", "--ledger", f"{scratch}/ledger", "--step-days", "4"]
    jobs.run_cli(args, spark)
    assert [(r.first, r.last, r.state) for r in RunLedger(spark, f"{scratch}/ledger").entries()] == [
        ("2024-01-02", "2024-01-05", "done"), ("2024-01-06", "2024-01-09", "done"), ("2024-01-10", "2024-01-10", "done")]
    assert spark.read.parquet(f"{scratch}/trusted").count() == sum(min(7, d.day - 1) for d in days)
    with pytest.raises(SystemExit):
        jobs.run_cli(args[:-4], spark)
    counts = Topic("counts", path=f"{scratch}/counts")
    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0, 10), 3)], "domain string, ten_second_window timestamp, count_actions long")
    write_topic(to_frames(rows, counts), counts)
    for q in stream_jobs.run(["segments", "--counts", counts.path, "--table", f"{scratch}/table", "--checkpoint", f"{scratch}/k", "--trigger", "available-now", "--compactable"], spark):
        ws.drain(q)
    jobs.run_cli(["compact", "--table", f"{scratch}/table", "--keep", "1"], spark)
    assert live(spark, f"{scratch}/table") == [(1, "a", 3)] and storage.names(spark, f"{scratch}/table/stream") == []


def test_counts_job_sends_bulks(spark, scratch):
    from tidemark.sinks.index import write_index_batch

    counts = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 0, 10), 3), (None, dt.datetime(2024, 1, 1, 0, 0, 10), 0)], "domain string, ten_second_window timestamp, count_actions long")
    for _ in range(2):  # a replayed micro-batch
        write_index_batch(counts, 0, scratch, format=bulk.FORMAT, options={"max_actions": "1"})
    from tidemark.schemas import WINDOW_COUNT

    rows = bulk.read_bulks(spark, scratch, WINDOW_COUNT).collect()
    assert sorted((r.domain or "", r.count_actions) for r in rows) == [("", 0), ("a", 3)] and len({r["_id"] for r in rows}) == 2
