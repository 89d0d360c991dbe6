"""Window-count index scan.

``format="parquet"`` reads the local form written by ``sinks.index``, one
document per id, the one written last (an aggregate that combines before its
shuffle, over window rows); any
other format (for example an Elasticsearch data source, if installed) is
passed to ``spark.read.format`` with its options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import WINDOW_COUNT

INDEX_DOC = T.StructType(
    [T.StructField("doc_id", T.StringType())] + list(WINDOW_COUNT.fields)
)

#: As stored: with the time, writer and micro-batch of the write.
STORED_DOC = T.StructType(
    list(INDEX_DOC.fields)
    + [
        T.StructField("written_at", T.TimestampType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def read_index(spark: SparkSession, path_or_index: str, format: str = "parquet", options: dict | None = None) -> DataFrame:
    if format == "parquet":
        stored = spark.read.schema(STORED_DOC).parquet(path_or_index)
        doc = F.struct("domain", "ten_second_window", "count_actions")
        last = F.max_by(doc, F.struct("written_at", "load_id", "batch_id"))
        return stored.groupBy("doc_id").agg(last.alias("doc")).select("doc_id", "doc.*")
    return spark.read.format(format).options(**(options or {})).load(path_or_index)
