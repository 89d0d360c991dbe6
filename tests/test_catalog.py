"""External table, partition discovery, SQL, named sources."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.pageviews import explode_run_dates
from tidemark.plans import catalog
from tidemark.sinks.layers import write_trusted


def _trusted_rows(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(10)]
    daily = spark.createDataFrame([(d, "en.wikipedia", 1 + i) for i, d in enumerate(days)],
                                  "pageview_date date, domain string, pageviews bigint")
    return explode_run_dates(daily, "2024-01-08", "2024-01-10").select(
        "domain", "pageviews", "pageview_date", "processing_date")


def test_external_table_repair_and_insert(spark, scratch):
    rows = _trusted_rows(spark)
    write_trusted(rows.where(F.col("processing_date") < F.lit(dt.date(2024, 1, 10))), f"{scratch}/trusted")
    catalog.create_database(spark, "tm_catalog_test", f"{scratch}/db")
    table = "tm_catalog_test.pageviews"
    catalog.create_trusted_table(spark, table, f"{scratch}/trusted")
    catalog.create_trusted_table(spark, table, f"{scratch}/trusted")  # IF NOT EXISTS
    assert spark.sql(f"SELECT count(*) FROM {table}").first()[0] == 0  # partitions unknown yet
    catalog.repair_table(spark, table)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2
    assert spark.sql(f"SELECT count(*) FROM {table}").first()[0] == 14
    # SQL insert of a new run; a second insert of the same run replaces it
    new_run = rows.where(F.col("processing_date") == F.lit(dt.date(2024, 1, 10)))
    catalog.insert_run(spark, table, new_run)
    catalog.insert_run(spark, table, new_run)
    assert spark.sql(f"SELECT count(*) FROM {table}").first()[0] == 21
    # partition filter prunes to one folder
    q = spark.sql(f"SELECT sum(pageviews) FROM {table} WHERE processing_date = DATE'2024-01-10'")
    assert q.first()[0] == sum(range(3, 10))
    # external: dropping the table keeps the files
    spark.sql(f"DROP TABLE {table}")
    assert spark.read.parquet(f"{scratch}/trusted").count() == 21


def test_registry_lists_sources_by_catalog(spark, scratch):
    reg = catalog.SourceRegistry()
    reg.add("lake", "events", "parquet", "/root/testdata/sf0.001/events.parquet")
    reg.add("lake", "nation", "parquet", "/root/testdata/sf0.001/nation.parquet")
    reg.add("olap", "region", "parquet", "/root/testdata/sf0.001/region.parquet")
    for name in ("lake", "olap"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    reg.register(spark, scratch)
    reg.register(spark, scratch)  # again: what exists stays
    dbs = {r[0] for r in spark.sql("SHOW DATABASES").collect()}
    assert {"lake", "olap"} <= dbs
    listing = {(r.catalog, r.table_name): r.n_rows for r in reg.listing(spark, counts=True).collect()}
    assert listing[("olap", "region")] == 5 and listing[("lake", "nation")] == 25
    # listed from the catalog: a table that others made is there too
    spark.sql("CREATE TABLE lake.own USING parquet AS SELECT 1 AS x")
    assert ("lake", "own") in {tuple(r) for r in reg.listing(spark).collect()}
    # one SQL surface across catalogs
    n = spark.sql("SELECT count(*) FROM lake.nation n JOIN olap.region r ON n.n_regionkey = r.r_regionkey").first()[0]
    assert n == 25


def test_register_never_drops_data(spark, scratch):
    spark.sql("DROP DATABASE IF EXISTS tm_keep CASCADE")
    catalog.create_database(spark, "tm_keep", f"{scratch}/db")
    spark.sql("CREATE TABLE tm_keep.events USING parquet AS SELECT 7 AS x")
    reg = catalog.SourceRegistry().add("tm_keep", "events", "parquet", "/root/testdata/sf0.001/events.parquet")
    with pytest.raises(ValueError, match="already stands"):
        reg.register(spark)
    assert spark.table("tm_keep.events").first().x == 7
    spark.sql("DROP DATABASE tm_keep CASCADE")


def test_insert_into_appends_and_overwrite_replaces(spark, scratch):
    rows = _trusted_rows(spark).where(F.col("processing_date") == F.lit(dt.date(2024, 1, 8)))
    catalog.create_database(spark, "tm_insert_test", f"{scratch}/db")
    table = "tm_insert_test.pageviews"
    catalog.create_trusted_table(spark, table, f"{scratch}/trusted")
    catalog.insert_run(spark, table, rows, overwrite=False)
    catalog.insert_run(spark, table, rows, overwrite=False)
    assert spark.table(table).count() == 2 * rows.count()
    catalog.insert_run(spark, table, rows, overwrite=True)
    assert spark.table(table).count() == rows.count()
    spark.sql(f"DROP TABLE {table}")


def test_insert_empties_runs_and_ignores_the_sessions_mode(spark, scratch):
    rows = _trusted_rows(spark)
    days = [dt.date(2024, 1, d) for d in (8, 9, 10)]
    catalog.create_database(spark, "tm_empty_test", f"{scratch}/db")
    table = "tm_empty_test.pageviews"
    catalog.create_trusted_table(spark, table, f"{scratch}/trusted")
    catalog.insert_run(spark, table, rows)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        catalog.insert_run(spark, table, rows.where(F.col("processing_date") == F.lit(days[0])), runs=days[:2])
    finally:
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    got = {r.processing_date: r["count"] for r in spark.table(table).groupBy("processing_date").count().collect()}
    assert got == {days[0]: 7, days[2]: 7}  # the 9th was answered for and has no rows; the 10th is as it was
    spark.sql(f"DROP TABLE {table}")
