"""Operator 2: exact top-k by inner product over a pivot-distance index.

Vectors become integers (``floor(scale * x)``).  With one more coordinate that
brings all of them to the same length, the largest inner products are the
smallest Euclidean distances, so a metric index applies.  Each vector is keyed
by its nearest pivot and its distance to it; the distances of a pivot are cut
into rings, sorted, and a ring's vectors lie in blocks of bounded size.

A query starts in the ring whose annulus is nearest to it and expands: first
the nearest ring that holds vectors, then the next few, then all that remain.
In each round it visits only rings whose triangle-inequality bound,
``max(d(q,p) - ring's far edge, ring's near edge - d(q,p))``, does not exceed
its k-th best distance so far, and stops when there is none.  Ties are kept by
comparing the bound with a small slack, so results are exact.

Pivots and ring edges come from a bounded sample (``sample`` rows, by hash);
every row is indexed.  What is broadcast is the pivots and the table of rings,
of fixed size.  A ring is dealt in blocks of rows and of queries, and these
meet by the ring and a salt of either side, about ``MEET`` blocks of each, so
neither a popular ring nor many copies of one vector meet in one task.

Defined results: a vector that is null or holds a null or non-finite component
takes no part, nor does one with a null id; vectors of different lengths are
compared as if padded with zeros; an id that occurs in several rows is asked
once (its smallest vector) and each of its rows is a candidate for others;
fewer candidates than ``k`` are all returned; an empty table gives no rows.
Scores are exact while they stay below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, shared, value_of, written

#: Rows of a data block and queries of a query block.
BLOCK, ASKED = 2048, 512
#: Blocks of either side that meet under one key.
MEET = 64
#: Rings visited in the second round.
NEXT = 8
SLACK = 1e-6


def integers(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v: array<double> of whole numbers), without vectors that take
    no part."""
    x = F.transform(col(vector_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        rows.filter(col(id_col).isNotNull() & col(vector_col).isNotNull() & ~bad)
        .select(col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(scale * c).cast("double")).alias("v"))
    )


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width``."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _decoded(code: bytes, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(code, kind).reshape(-1, width).astype(float)


class Index:
    """Pivots, ring edges and the arithmetic of bounds."""

    def __init__(self, sample: np.ndarray, width: int, longest: float, pivots: int, rings: int):
        self.width, self.longest = width, longest
        lifted = self.lift(sample)
        # Pivots far from each other: each next one is the sample row
        # farthest from those chosen, which then moves to its cell's mean.
        chosen = [0]
        far = ((lifted - lifted[0]) ** 2).sum(axis=1)
        while len(chosen) < min(pivots, len(lifted)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
        self.pivots = lifted[chosen]
        for _ in range(5):
            near = self.distances(lifted).argmin(axis=1)
            self.pivots = np.stack([lifted[near == p].mean(axis=0) if (near == p).any() else self.pivots[p] for p in range(len(self.pivots))])
        distance = self.distances(lifted)
        near = distance.argmin(axis=1)
        steps = np.arange(1, rings) / rings
        self.edges = [
            np.quantile(distance[near == p, p], steps) if (near == p).any() else np.zeros(rings - 1) for p in range(len(self.pivots))
        ]

    def lift(self, vectors: np.ndarray, asked: bool = False) -> np.ndarray:
        """One more coordinate: for a candidate what its length lacks, for a
        query zero."""
        square = (vectors**2).sum(axis=1)
        more = np.zeros(len(vectors)) if asked else np.sqrt(np.maximum(0.0, self.longest - square))
        return np.column_stack([vectors, more])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(0.0, square))

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pivot, ring, distance) of each candidate."""
        distance = self.distances(self.lift(vectors))
        pivot = distance.argmin(axis=1)
        own = distance[np.arange(len(pivot)), pivot]
        ring = np.array([np.searchsorted(self.edges[p], d) for p, d in zip(pivot, own)], np.int64)
        return pivot, ring, own


def _blocks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Rows of one cell at a time, at most ``size``: the input is sorted by cell."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = held["cell"].iloc[-1] if len(held) else None
        for _, own in held[held["cell"] != last].groupby("cell", sort=False):
            for at in range(0, len(own), size):
                yield own[at:at + size]
        held = held[held["cell"] == last]
        while len(held) >= size:
            yield held[:size]
            held = held[size:]
    if held is not None and len(held):
        yield held


def _packed(size: int):
    """Sorted rows (cell, vec_id, code) -> blocks (cell, ids, vectors), as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in _blocks(batches, size):
            yield pd.DataFrame({
                "cell": [own["cell"].iloc[0]],
                "ids": [own["vec_id"].to_numpy(np.int64).tobytes()],
                "vectors": [b"".join(own["code"])],
            })

    return run


def _visit(width: int, kind: str, k: int):
    """Pairs of a query block and a data block -> the k best of each query."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, pair in batch.iterrows():
                asked = np.frombuffer(pair["asked"], np.int64)
                ids = np.frombuffer(pair["ids"], np.int64)
                scores = _decoded(pair["questions"], width, kind) @ _decoded(pair["vectors"], width, kind).T
                scores[asked[:, None] == ids[None, :]] = -np.inf
                out = []
                for q, row in zip(asked, scores):
                    cut = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                    best = np.flatnonzero((row >= cut) & (row > -np.inf))
                    best = best[np.lexsort((ids[best], -row[best]))[:k]]
                    out.append((np.full(len(best), q), ids[best], row[best].astype(np.int64)))
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    return run


def _salts(blocks: DataFrame) -> Column:
    """How many salts the blocks of a ring are dealt by (null: it has none).
    One count per ring, ``pivots * rings`` at most, reaches the driver."""
    counts = blocks.groupBy("cell").count().collect()
    return F.create_map(*[F.lit(x) for r in counts for x in (r["cell"], -(-r["count"] // MEET))])[F.col("cell")] if counts else F.lit(None).cast("long")


def _meetings(asked: DataFrame, blocks: DataFrame, data_salts: Column) -> DataFrame:
    """All pairs of a query block and a data block of the same ring."""

    def each(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))

    query_salts = _salts(asked)
    left = asked.withColumn("query_salt", F.pmod(F.xxhash64("asked"), query_salts)).withColumn("data_salt", each(data_salts))
    right = blocks.withColumn("data_salt", F.pmod(F.xxhash64("ids"), data_salts)).withColumn("query_salt", each(query_salts))
    key = ["cell", "data_salt", "query_salt"]
    return left.join(right, key).drop("data_salt", "query_salt")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    every: int = 50,
    pivots: int = 32,
    rings: int = 8,
    sample: int = 4096,
) -> DataFrame:
    """Queries: rows whose id is divisible by ``every``; candidates: all other
    rows.  (query_id, rank, vec_id, score)."""
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    vectors = written(integers(rows, id_col, vector_col, scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    facts = vectors.agg(
        F.max(F.size("v")).alias("width"), F.max(square).alias("longest"), F.max(largest).alias("largest")
    ).first()
    if facts["width"] is None:
        return spark.createDataFrame([], schema)
    width = max(1, facts["width"])
    kind = "<i2" if facts["largest"] < 1 << 15 else "<f8"  # a component's bytes, where vectors are moved
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    fitted = Index(_matrix(list(picked["v"]), width), width, facts["longest"], pivots, rings)
    index = shared(spark, fitted)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = value_of(index)
        for batch in batches:
            if len(batch):
                whole = _matrix(list(batch["v"]), width)
                pivot, ring, distance = own.place(whole)
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"],
                    "code": [x.tobytes() for x in whole.astype(kind)],
                    "cell": pivot * rings + ring,
                    "distance": distance,
                })

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = vectors.mapInPandas(place, "vec_id long, code binary, cell long, distance double")
    sorted_rows = placed.repartitionByRange(parts, "cell", "distance", "vec_id").sortWithinPartitions("cell", "distance", "vec_id")
    keyed = written(sorted_rows, "annuli")
    blocks = written(
        keyed.select("cell", "vec_id", "code").mapInPandas(_packed(BLOCK), "cell long, ids binary, vectors binary"), "blocks"
    )
    cells = keyed.groupBy("cell").agg(F.min("distance").alias("near"), F.max("distance").alias("far"), F.count("*").alias("n")).toPandas()
    cells = cells.sort_values("cell", ignore_index=True)
    table = shared(spark, (fitted, cells))

    queries = written(
        keyed.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("code").alias("code")), "queries"
    )

    def visits(start: int, stop: int | None):
        """(cell, vec_id, code) for the rings from place ``start`` to ``stop``
        in a query's order of bounds, as far as its k-th distance allows."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own, ring = value_of(table)
            cell, near, far = (ring[x].to_numpy() for x in ("cell", "near", "far"))
            for batch in batches:
                if not len(batch):
                    continue
                asked = _decoded(b"".join(batch["code"]), width, kind)
                reach = own.distances(own.lift(asked, asked=True))[:, cell // rings]
                bound = np.maximum(np.maximum(reach - far, near - reach), 0.0)
                order = np.argsort(bound, axis=1, kind="stable")[:, start:stop]
                # Of two vectors, the one with the larger inner product is the
                # nearer: distance^2 = longest + |q|^2 - 2 * score.
                limit = own.longest + (asked**2).sum(axis=1) - 2 * batch["kth"].astype(float).fillna(-np.inf).to_numpy()
                limit = np.sqrt(np.maximum(limit, 0.0)) * (1 + SLACK) + SLACK
                query, place = np.nonzero(np.take_along_axis(bound, order, 1) <= limit[:, None])
                yield pd.DataFrame({
                    "cell": cell[order[query, place]],
                    "vec_id": batch["vec_id"].to_numpy()[query],
                    "code": batch["code"].to_numpy()[query],
                })

        return run

    data_salts = _salts(blocks)
    best = None
    for start, stop in ((0, 1), (1, 1 + NEXT), (1 + NEXT, None)):
        if best is None:
            asked = queries.withColumn("kth", F.lit(None).cast("long"))
        else:
            kth = best.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
            asked = queries.join(kth, "vec_id", "left")
        going = asked.mapInPandas(visits(start, stop), "cell long, vec_id long, code binary")
        grouped = written(
            going.repartitionByRange(parts, "cell", "vec_id").sortWithinPartitions("cell", "vec_id")
            .mapInPandas(_packed(ASKED), "cell long, ids binary, vectors binary")
            .select("cell", F.col("ids").alias("asked"), F.col("vectors").alias("questions")),
            "asked",
        )
        found = _meetings(grouped, blocks, data_salts).mapInPandas(_visit(width, kind, k), "query_id long, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = written(_best(found, k), "best")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
