"""T2, G1, P3, P18 on FIXTURES F5/F6 rows."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.windows import tumbling_count

from plans import plan_text


def _t(s):
    return dt.datetime.fromisoformat("2024-01-01 " + s)


def test_window_end_label_null_key_and_boundary(spark):
    rows = [("a", _t("00:00:09.500")), (None, _t("00:00:09.500")), ("b", _t("00:00:10.000")),
            ("a", _t("00:00:01.000"))]
    df = spark.createDataFrame(rows, "domain string, createTime timestamp_ntz")
    out = {(r.domain, r.ten_second_window): r.count_actions for r in tumbling_count(df).collect()}
    assert out == {
        ("a", _t("00:00:10")): 2,
        (None, _t("00:00:10")): 0,  # null key forms its own group, counts 0
        ("b", _t("00:00:20")): 1,  # window is [start, end): 10.000 opens the next one
    }


def test_schema_matches_sink_declaration(spark):
    df = spark.createDataFrame([("a", _t("00:00:01"))], "domain string, createTime timestamp")
    out = tumbling_count(df)
    assert out.columns == ["domain", "ten_second_window", "count_actions"]
    fields = {f.name: f for f in out.schema.fields}
    assert fields["count_actions"].dataType.simpleString() == "bigint"
    assert not fields["count_actions"].nullable
    assert fields["ten_second_window"].dataType.simpleString() == "timestamp"


def test_count_sum_equals_non_null_keys(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = ev.select(F.nullif("event_type", F.lit("error")).alias("domain"), F.col("ts").alias("createTime"))
    total = tumbling_count(df).agg(F.sum("count_actions")).first()[0]
    assert total == df.where(F.col("domain").isNotNull()).count()


def test_plan_is_one_shuffle_with_partial_aggregation(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df = ev.select(F.col("event_type").alias("domain"), F.col("ts").alias("createTime"))
    plan = plan_text(tumbling_count(df), "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan
    # Only the two columns used are read from Parquet.
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in scan
