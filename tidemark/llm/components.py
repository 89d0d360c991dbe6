"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour (combined before the shuffle)."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, label): label is the smallest node of
    the component.  Nodes without an edge do not appear.

    Large star: each node hands its larger neighbours its smallest one.  Small
    star: the same for its smaller neighbours and itself.  Both are a grouped
    minimum and a join, so a hub is not gathered in one task.  Every round is
    written to the shared folder; the rounds end when each node points
    straight at a label that points nowhere."""
    now = written(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hub = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(hub, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = _least(large)
        small = (
            large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        )
        now = written(small, "edges")
        several = now.groupBy("u").count().filter("count > 1").select(F.lit(1))
        chained = now.alias("x").join(now.alias("y"), F.col("x.v") == F.col("y.u"), "left_semi").select(F.lit(1))
        if several.unionByName(chained).isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
