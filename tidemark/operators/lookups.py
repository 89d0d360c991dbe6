"""Query-time lookups (C3) and a lookup kept current from a topic (C4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.codec import parse_json_value

#: A lookup side is broadcast only up to this many bytes, as measured.
BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, about as they would stand in memory: the text of
    each column and 16 bytes beside it.  One aggregate, combined before its
    shuffle; one number reaches the driver."""
    width = sum((F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its measured size is at most ``max_bytes``;
    beyond it the side is returned unchanged and the join shuffles.  The
    result is the same either way."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def lookup_join(df: DataFrame, lookup: DataFrame, on, how: str = "left", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Enrich ``df`` with columns of a small dimension at query time."""
    return df.join(bounded_broadcast(lookup, max_bytes), on=on, how=how)


def latest_per_key(df: DataFrame, key_col: str, value_cols, order_col: str) -> DataFrame:
    """C4: the value with the greatest ``order_col`` per key.

    ``max_by`` is a declarative aggregate: partial per map task, then one
    shuffle of one row per key and task, so a hot key is combined before it
    moves.
    """
    if isinstance(value_cols, str):
        value_cols = [value_cols]
    return df.groupBy(key_col).agg(
        *[F.max_by(F.col(c), F.col(order_col)).alias(c) for c in value_cols]
    )


def latest_from_topic(frames: DataFrame, schema, key_col: str, value_cols) -> DataFrame:
    """C4: a lookup kept current from a topic of updates (JSON values).  The
    latest update per key wins, ordered by record time, then partition and
    offset where the topic has them, then the value itself, so the order is
    total.  Like ``latest_per_key`` this combines before its one shuffle."""
    if isinstance(value_cols, str):
        value_cols = [value_cols]
    updates = frames.select(
        F.struct(F.col("timestamp"), F.col("partition"), F.col("offset"), F.col("value")).alias("_order"),
        parse_json_value("value", schema).alias("_v"),
    ).select("_order", "_v.*")
    return updates.groupBy(key_col).agg(
        *[F.max_by(F.col(c), F.col("_order")).alias(c) for c in value_cols]
    )


def enrich(events: DataFrame, lookup: DataFrame, key_col: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join of events (batch or stream) with a lookup table;
    the lookup is broadcast only within the checked bound.  On a stream this
    is a stream-static join: each micro-batch probes the same lookup."""
    return events.join(bounded_broadcast(lookup, max_bytes), on=key_col, how="left")
