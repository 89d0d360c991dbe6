"""External table, partition discovery, SQL and named sources."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import TRUSTED_TABLE_DDL

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    for part in name.split("."):
        if not _IDENT.match(part):
            raise ValueError(f"not a plain identifier: {name!r}")
    return name


def _literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}{loc}")


def create_trusted_table(spark: SparkSession, name: str, location: str) -> None:
    """Q1: external table over the trusted layer, created if missing."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({TRUSTED_TABLE_DDL}) "
        f"USING parquet PARTITIONED BY (processing_date) LOCATION {_literal(location)}"
    )


def repair_table(spark: SparkSession, name: str) -> None:
    """Q2: register partition folders written since the last repair."""
    spark.sql(f"MSCK REPAIR TABLE {_ident(name)}")


def insert_run(spark: SparkSession, name: str, rows: DataFrame, overwrite: bool = True, runs: Iterable | None = None) -> None:
    """SQL insert of run partitions into the external table; with
    ``overwrite`` the run dates present in ``rows`` are replaced, and each of
    ``runs``, the dates the insert answers for, even if it has no rows.  Other
    runs stay, whatever the session's overwrite mode is."""
    view = f"_tidemark_insert_{uuid.uuid4().hex[:12]}"
    rows = rows.select("domain", "pageviews", "pageview_date", "processing_date")
    seen = Observation()
    rows.observe(seen, F.collect_set("processing_date").alias("there")).createOrReplaceTempView(view)
    verb = "INSERT OVERWRITE" if overwrite else "INSERT INTO"
    try:
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            spark.sql(
                f"{verb} {_ident(name)} PARTITION (processing_date) "
                f"SELECT domain, pageviews, pageview_date, processing_date FROM {view}"
            )
        if overwrite and runs is not None:
            for run in sorted(set(runs) - set(seen.get["there"] or ())):
                spark.sql(
                    f"INSERT OVERWRITE {_ident(name)} PARTITION (processing_date = DATE '{run.isoformat()}') "
                    f"SELECT domain, pageviews, pageview_date FROM {view} WHERE false"
                )
    finally:
        spark.catalog.dropTempView(view)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for one statement."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


@dataclass
class Source:
    catalog: str
    table: str
    format: str
    path: str
    options: dict = field(default_factory=dict)
    schema: str | None = None
    partitions: tuple[str, ...] = ()


def _plain(path: str) -> str:
    """A path without the ways of writing a local scheme."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


@dataclass
class SourceRegistry:
    """Q3: named sources grouped by catalog, all queried through one SQL
    surface.  Each catalog is a database; each source an external table
    (dropping one never deletes data)."""

    sources: list[Source] = field(default_factory=list)

    def add(self, catalog: str, table: str, format: str, path: str, schema: str | None = None,
            partitions: tuple[str, ...] = (), **options) -> "SourceRegistry":
        """``schema`` is the column list in DDL; without one it is inferred."""
        self.sources.append(Source(catalog, table, format, path, options, schema, partitions))
        return self

    def register(self, spark: SparkSession, db_location_root: str | None = None) -> None:
        """Create what is missing.  A table that exists stays as it is; one
        that stands at another location is an error, never dropped."""
        for catalog in sorted({s.catalog for s in self.sources}):
            loc = f"{db_location_root}/{catalog}.db" if db_location_root else None
            create_database(spark, catalog, loc)
        for s in self.sources:
            name = f"{_ident(s.catalog)}.{_ident(s.table)}"
            columns = f" ({s.schema})" if s.schema else ""
            parts = f" PARTITIONED BY ({', '.join(map(_ident, s.partitions))})" if s.partitions else ""
            opts = ", ".join(f"{_literal(k)} {_literal(str(v))}" for k, v in s.options.items())
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name}{columns} USING {s.format}"
                + (f" OPTIONS ({opts})" if opts else "") + parts + f" LOCATION {_literal(s.path)}"
            )
            there = next(
                r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location"
            )
            if _plain(there) != _plain(s.path):
                raise ValueError(f"{name} already stands at {there}, not at {s.path}")
            # Partition folders already on storage become visible only
            # after discovery (Q2).
            if any(c.isPartition for c in spark.catalog.listColumns(name)):
                repair_table(spark, name)

    def listing(self, spark: SparkSession, counts: bool = False) -> DataFrame:
        """One row per table that the registered catalogs hold, as the catalog
        lists them; with ``counts`` also its number of rows (a scan)."""
        found = sorted(
            {(c, t.name) for c in {s.catalog for s in self.sources} for t in spark.catalog.listTables(c) if not t.isTemporary}
        )
        if not counts:
            return spark.createDataFrame(found, "catalog string, table_name string")
        parts = [
            spark.table(f"{c}.{t}").agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(c).alias("catalog"), F.lit(t).alias("table_name"), "n_rows"
            )
            for c, t in found
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
