"""Window-count index sink (K4).

Streams write through ``foreachBatch``.  Every document gets a
deterministic id ``sha2(domain $ window end)`` so a replayed micro-batch
rewrites the same documents instead of adding copies.  The local form keeps
one Parquet partition per writer and micro-batch and overwrites it on replay;
its reader folds documents by id.  The format ``tidemark_bulk`` sends bulks
(``sinks.bulk``); any other index format receives the id as its document key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import EVENT_TIME_FORMAT
from tidemark.sinks import bulk


def with_doc_id(df: DataFrame) -> DataFrame:
    # A null domain and an empty one are different documents: tag the value.
    domain = F.when(F.col("domain").isNull(), F.lit("N")).otherwise(F.concat(F.lit("S"), F.col("domain")))
    key = F.concat_ws("$", domain, F.date_format("ten_second_window", EVENT_TIME_FORMAT))
    return df.select(F.sha2(key, 256).alias("doc_id"), "domain", "ten_second_window", "count_actions")


def write_index_batch(df: DataFrame, batch_id: int, target: str, format: str = "parquet", options: dict | None = None,
                      load_id: str = "batch") -> None:
    """``load_id`` names the writer (a stream's own id, which its checkpoint
    keeps): a replayed micro-batch replaces itself, and batches of another
    checkpoint are never taken for it."""
    docs = with_doc_id(df)
    if format == "parquet":
        (
            docs.withColumns({
                "written_at": F.current_timestamp(), "load_id": F.lit(load_id), "batch_id": F.lit(batch_id).cast("bigint")
            })
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load_id", "batch_id")
            .parquet(target)
        )
    elif format == bulk.FORMAT:
        bulk.write_bulk(docs, target, "doc_id", **(options or {}))
    else:
        # Bulk requests of at most 32 documents / 42 MB, retried after 1 s.
        opts = {
            "es.mapping.id": "doc_id",
            "es.batch.size.entries": "32",
            "es.batch.size.bytes": "42mb",
            "es.batch.write.retry.wait": "1s",
        }
        opts.update(options or {})
        docs.write.format(format).options(**opts).mode("append").save(target)


def index_writer(target: str, format: str = "parquet", options: dict | None = None):
    """The ``foreachBatch`` function for a window-count stream."""

    def _write(df: DataFrame, batch_id: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        write_index_batch(df, batch_id, target, format, options, load_id=query)

    return _write
