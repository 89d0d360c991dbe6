"""The driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table_glob(sf_dir: str, name: str) -> str:
    """The table as a one-alternative glob: file stream sources take a folder
    or a glob, and a table stored as a single file is neither."""
    return f"{sf_dir.rstrip('/')}/{{{name}.parquet}}"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; a column list is applied right away so the scan's
    ``ReadSchema`` holds only what the query uses."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
