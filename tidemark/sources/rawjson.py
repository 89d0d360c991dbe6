"""Raw pageview layer scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.pageviews import as_date
from tidemark.schemas import RAW_PAGEVIEW, RAW_PAGEVIEW_PARTITIONED


def read_raw(spark: SparkSession, path: str, multiline: bool = False, partitioned: bool = True) -> DataFrame:
    """Raw pageview JSON with a declared schema (no inference pass).

    ``multiline=True`` reads files that each hold one JSON array (the
    layout written by the single-process collector); the default reads
    JSON lines, the layout ``sinks.layers.write_raw`` produces, which
    splits across tasks.  With ``partitioned`` the ``processing_date=…``
    folders become a typed DATE column.
    """
    schema = RAW_PAGEVIEW_PARTITIONED if partitioned else RAW_PAGEVIEW
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_raw_run(spark: SparkSession, root: str, ds, multiline: bool = False) -> DataFrame:
    """Exactly one run's records.  The run date is a filter on the
    partition column, so only that folder is listed and read."""
    return read_raw(spark, root, multiline=multiline).where(
        F.col("processing_date") == F.lit(as_date(ds))
    )
