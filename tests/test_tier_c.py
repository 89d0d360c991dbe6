"""Sketches and lookups checked against exact answers."""

from pyspark.sql import functions as F

from tidemark.operators import lookups, sketches

from plans import plan_text

SF = "/root/testdata/sf0.01"


def test_approx_distinct_within_error(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    approx = {r.event_type: r.approx_distinct for r in sketches.approx_distinct(ev, ["event_type"], "user_id").collect()}
    exact = {r.event_type: r.n for r in ev.groupBy("event_type").agg(F.countDistinct("user_id").alias("n")).collect()}
    for k, n in exact.items():
        assert abs(approx[k] - n) <= max(3, 0.06 * n)


def test_hll_sketches_merge(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("day", F.to_date("ts"))
    daily = sketches.hll_sketches(ev, ["event_type", "day"], "user_id")
    merged = {r.event_type: r.approx_distinct for r in sketches.merge_hll(daily, ["event_type"]).collect()}
    exact = {r.event_type: r.n for r in ev.groupBy("event_type").agg(F.countDistinct("user_id").alias("n")).collect()}
    for k, n in exact.items():
        assert abs(merged[k] - n) <= max(3, 0.06 * n)


def test_approx_quantiles_rank_error(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    q = sketches.approx_quantiles(ev, ["event_type"], "value").collect()
    values = {}
    for r in ev.select("event_type", "value").collect():
        values.setdefault(r.event_type, []).append(r.value)
    for row in q:
        vs = sorted(values[row.event_type])
        for p, got in ((0.5, row.p50), (0.9, row.p90), (0.99, row.p99)):
            rank = sum(v <= got for v in vs) / len(vs)
            assert abs(rank - p) <= 0.01


def test_histogram_counts_all_rows(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    h = sketches.approx_histogram(ev, ["event_type"], "value", bins=8).collect()
    assert sum(sum(b.y for b in r.histogram) for r in h) == ev.count()


def test_bounded_broadcast_checks_size(spark):
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    small = lookups.lookup_join(customer, nation, customer["c_nationkey"] == nation["n_nationkey"], max_bytes=1 << 20)
    assert "BroadcastHashJoin" in plan_text(small, "simple")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = lookups.lookup_join(customer, nation, customer["c_nationkey"] == nation["n_nationkey"], max_bytes=10)
        assert "BroadcastHashJoin" not in plan_text(big, "simple")
        assert big.count() == small.count() == customer.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_per_key(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    got = {r.user_id: r.value for r in lookups.latest_per_key(ev, "user_id", "value", "event_id").collect()}
    last = {}
    for r in ev.select("user_id", "event_id", "value").orderBy("event_id").collect():
        last[r.user_id] = r.value
    assert got == last


def test_theta_set_operations_within_error(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("half", (F.dayofmonth("ts") > 15).cast("int"))
    first = sketches.theta_sketches(ev.where("half = 0"), ["event_type"], "user_id")
    second = sketches.theta_sketches(ev.where("half = 1"), ["event_type"], "user_id")
    got = {r.event_type: r for r in sketches.theta_overlap(first, second, "event_type").collect()}
    users = {}
    for r in ev.select("event_type", "half", "user_id").collect():
        users.setdefault((r.event_type, r.half), set()).add(r.user_id)
    for t, row in got.items():
        a, b = users[(t, 0)], users[(t, 1)]
        for est, exact in ((row.in_both, len(a & b)), (row.left_only, len(a - b)), (row.in_either, len(a | b))):
            assert abs(est - exact) <= max(3, 0.05 * exact)


def test_lookup_kept_current_from_topic_and_stream_static_join(spark, scratch):
    import datetime as dt

    from pyspark.sql import types as T

    from tidemark.sinks.topics import to_frames, write_topic
    from tidemark.sources.topics import Topic, read_topic

    topic = Topic("user-tiers", path=f"{scratch}/tiers")
    t0 = dt.datetime(2024, 1, 1)
    updates = spark.createDataFrame(
        [(1, "free", t0), (2, "free", t0), (1, "pro", t0 + dt.timedelta(minutes=1)), (3, "pro", t0)],
        "user_id bigint, tier string, at timestamp",
    )
    write_topic(to_frames(updates, topic, value_cols=["user_id", "tier"], timestamp_col="at"), topic)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("tier", T.StringType())])
    latest = lookups.latest_from_topic(read_topic(spark, topic), schema, "user_id", "tier")
    assert sorted(tuple(r) for r in latest.collect()) == [(1, "pro"), (2, "free"), (3, "pro")]
    # stream-static join: events stream enriched with the current tier
    ev_path = f"{scratch}/events"
    spark.createDataFrame([(10, 1), (11, 2), (12, 4)], "event_id bigint, user_id bigint").write.parquet(ev_path)
    stream = spark.readStream.schema("event_id bigint, user_id bigint").parquet(ev_path)
    q = (lookups.enrich(stream, latest, "user_id").writeStream.format("parquet")
         .option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    out = sorted((r.event_id, r.tier) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert out == [(10, "pro"), (11, "free"), (12, None)]
