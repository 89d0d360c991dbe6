"""Operator 3: SimHash near-duplicates by a self-join of binary tries.

Fingerprints: texts with A-Z lower-cased, words between ASCII white space,
shingles of ``shingle_words`` words (repeats included), each hashed by XXH64;
a bit is 1 if it is set in over half of the hashes.

Links: distinct fingerprints at ``max_bits`` or fewer differing bits.  They
stand in ``max_bits + 1`` binary tries, each of which reads the 64 bits from
another starting point: of two fingerprints within the budget, at least one
trie has both below the same top node.  The self-join descends from pairs of
nodes to pairs of their children, adds the bits in which the two differ, and
drops a pair that is over budget.  The upper levels are Spark rows: a node
pair with more than ``LEAF`` fingerprints is split into its children's pairs,
eight levels at a time and as often as needed, so a hot node is spread over
many tasks.  Smaller pairs are finished in a task, on sorted arrays.
Components of the links are found by :mod:`tidemark.llm.components`.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; a shorter text is one shingle; repeated rows each get a row;
a null id never becomes a component's id unless all are null; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ID, KEY_A, KEY_B, col, keep_winners, keyed, small_batches, text_or_empty, written
from tidemark.llm.components import components

BITS = 64
SEED = 42
#: A node pair with at most so many fingerprints is finished in one task.
LEAF = 4096
#: Levels by which a larger node pair is split at once.
STEP = 8
#: Shingles hashed at once, so that a very long text needs no more memory.
SHINGLES = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    width = min(shingle_words, len(words))
    n = len(words) - width + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, SHINGLES):
        pairs = zip(start[at:min(at + SHINGLES, n)].tolist(), end[at + width - 1:at + SHINGLES + width - 1].tolist())
        hashes = np.array([hashed(joined[a:b], SEED) for a, b in pairs], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def fingerprints(shingle_words: int):
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, shingle_words) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    return run


def _top(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, BITS - bits)


def _rotated(value: Column, by: int) -> Column:
    return value if by == 0 else F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))


def _children(rows: DataFrame, depth: int, step: int, max_bits: int) -> DataFrame:
    """The pairs of children of each node pair, within the budget that is
    left: each fingerprint goes to every pair that its own child belongs to."""
    masks = [m for m in range(1 << step) if bin(m).count("1") <= max_bits]
    options = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(bin(m).count("1")).alias("bits")) for m in masks])
    own = _top(F.col("v"), depth + step)
    low = own.bitwiseAND(F.lit((1 << step) - 1))
    same = F.col("a") == F.col("b")
    mate_top = F.when(same, F.col("a")).when(F.col("side") == 0, F.col("b")).otherwise(F.col("a"))
    spread = rows.select(
        "trie", "a", "b", "err", "side", "v", own.alias("own"), low.alias("low"), mate_top.alias("mate_top"),
        F.explode(F.filter(options, lambda o: F.col("err") + o["bits"] <= max_bits)).alias("o"),
    )
    mate = F.shiftleft(F.col("mate_top"), step).bitwiseOR(F.col("low").bitwiseXOR(F.col("o.mask")))
    return spread.withColumn("mate", mate).select(
        "trie",
        F.least("own", "mate").alias("a"),
        F.greatest("own", "mate").alias("b"),
        (F.col("err") + F.col("o.bits")).alias("err"),
        F.when(F.col("own") <= F.col("mate"), 0).otherwise(1).alias("side"),
        "v",
    )


def _descend(values: np.ndarray, selves: tuple, pairs: tuple, depth: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Finish node pairs on arrays.  ``values`` is sorted inside each node; a
    node is a range of it.  selves: (lo, hi); pairs: (alo, ahi, blo, bhi, err).
    Gives the index pairs within the budget."""
    found_a, found_b = [], []
    lo, hi = selves
    alo, ahi, blo, bhi, err = pairs
    for level in range(depth, BITS + 1):
        alone = (ahi - alo == 1) & (bhi - blo == 1)
        if alone.any():  # two single fingerprints: count what is left at once
            i, j = alo[alone], blo[alone]
            near = np.bitwise_count(values[i] ^ values[j]) <= max_bits
            found_a.append(i[near])
            found_b.append(j[near])
            alo, ahi, blo, bhi, err = (x[~alone] for x in (alo, ahi, blo, bhi, err))
        more = hi - lo > 1
        lo, hi = lo[more], hi[more]
        if level == BITS or not (len(lo) or len(alo)):
            break
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(BITS - 1 - level)) & np.uint64(1)).astype(np.int64)])
        cut = lambda x, y: y - (ones[y] - ones[x])  # noqa: E731  where the node's second child begins
        mid, amid, bmid = cut(lo, hi), cut(alo, ahi), cut(blo, bhi)
        nodes = [
            (lo, mid, mid, hi, np.ones(len(lo), np.int64)),
            (alo, amid, blo, bmid, err),
            (amid, ahi, bmid, bhi, err),
            (alo, amid, bmid, bhi, err + 1),
            (amid, ahi, blo, bmid, err + 1),
        ]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*nodes))
        keep = (ahi > alo) & (bhi > blo) & (err <= max_bits)
        alo, ahi, blo, bhi, err = (x[keep] for x in (alo, ahi, blo, bhi, err))
        lo, hi = np.concatenate([lo, mid]), np.concatenate([mid, hi])
    return np.concatenate([*found_a, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*found_b, np.empty(0, np.int64)]).astype(np.int64)


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index linked to each of n."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    return label


def _finish(depth: int, max_bits: int):
    """Rows (trie, shift, err, whole, a_values, b_values) -> links (u, v):
    each fingerprint to the first one that its node pair links it with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, owner, lo, hi, pairs, at = [], [], [], [], [], 0
            for whole, err, first, second in zip(batch.whole, batch.err, batch.a_values, batch.b_values):
                a = np.sort(np.array(first, np.int64).view(np.uint64))
                b = np.sort(np.array(second, np.int64).view(np.uint64))
                values += [a, b]
                if whole:
                    lo.append(at)
                    hi.append(at + len(a))
                else:
                    pairs.append((at, at + len(a), at + len(a), at + len(a) + len(b), err))
                at += len(a) + len(b)
            if not at:
                continue
            flat = np.concatenate(values)
            owner = np.repeat(np.repeat(batch["shift"].to_numpy(np.uint64), 2), [len(x) for x in values])
            ranges = np.array(pairs, np.int64).reshape(-1, 5).T
            i, j = _descend(flat, (np.array(lo, np.int64), np.array(hi, np.int64)), tuple(ranges), depth, max_bits)
            label = _labels(len(flat), i, j)
            linked = np.flatnonzero(label != np.arange(len(flat)))
            back = (flat >> owner) | np.where(owner == 0, np.uint64(0), flat << ((np.uint64(BITS) - owner) % np.uint64(BITS)))
            back = back.view(np.int64)
            yield pd.DataFrame({"u": back[linked], "v": back[label[linked]]})

    return run


def links(distinct: DataFrame, max_bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """``distinct`` (fp: long, no repeats) -> (u, v), whose components are
    those of all pairs at ``max_bits`` or fewer differing bits."""
    spark = distinct.sparkSession
    small_batches(spark)
    depth = BITS // (max_bits + 1)
    shifts = [depth * k for k in range(max_bits + 1)]
    tries = F.array(*[F.struct(F.lit(s).alias("trie"), _rotated(F.col("fp"), s).alias("v")) for s in shifts])
    top = _top(F.col("v"), depth)
    rows = distinct.select(F.explode(tries).alias("t")).select("t.*").select(
        "trie", top.alias("a"), top.alias("b"), F.lit(0).alias("err"), F.lit(0).alias("side"), "v"
    )
    pair, found = ["trie", "a", "b"], None
    while True:
        rows = written(rows, "trie-rows")
        sizes = rows.groupBy(*pair).agg(F.count("*").alias("n"), F.sum("side").cast("long").alias("n_b"))
        both = sizes.filter("a = b AND n > 1 OR a <> b AND n_b > 0 AND n_b < n")
        sides = [
            F.collect_list(F.when(F.col("side") == k, F.col("v"))).alias(name) for k, name in ((0, "a_values"), (1, "b_values"))
        ]
        ready = (
            rows.join(both.filter(F.col("n") <= leaf).select(*pair), pair)
            .groupBy(*pair)
            .agg(F.min("err").alias("err"), *sides)
            .select(F.col("trie").alias("shift"), "err", (F.col("a") == F.col("b")).alias("whole"), "a_values", "b_values")
        )
        done = written(ready.mapInPandas(_finish(depth, max_bits), "u long, v long"), "links")
        found = done if found is None else found.unionByName(done)
        hot = both.filter(F.col("n") > leaf).select(*pair)
        if depth >= BITS or hot.isEmpty():
            return found
        step = min(STEP, BITS - depth)
        rows = _children(rows.join(hot, pair), depth, step, max_bits)
        depth += step


def _linked(light: DataFrame, max_bits: int, leaf: int) -> DataFrame:
    """(fp, label): the component of each distinct fingerprint in ``light``."""
    distinct = light.select("fp").distinct()
    label = components(links(distinct, max_bits, leaf))
    return distinct.join(label, distinct.fp == label.node, "left").select("fp", F.coalesce("label", "fp").alias("label"))


def _light(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    small_batches(docs.sparkSession)
    return written(
        docs.select(col(id_col).alias(ID), *keyed(text_col), fingerprints(shingle_words)(text_or_empty(text_col)).alias("fp")),
        "fingerprints",
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_bits: int = 2,
    leaf: int = LEAF,
) -> DataFrame:
    """One row per document: id, fingerprint, component_id."""
    light = _light(docs, id_col, text_col, shingle_words)
    label = written(_linked(light, max_bits, leaf), "labels")
    least = light.groupBy("fp").agg(F.min(ID).alias("least")).join(label, "fp")
    component = written(
        label.join(least.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("fp", "component_id"),
        "component",
    )  # written, so that adaptive execution can split a hot fingerprint in the join
    return light.join(component, "fp").select(
        F.col(ID).alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_bits: int = 2,
    leaf: int = LEAF,
) -> DataFrame:
    """One document of each component stays, with all its columns: the one of
    the smallest id (a null id last)."""
    light = _light(docs, id_col, text_col, shingle_words)
    label = written(_linked(light, max_bits, leaf), "labels")
    rows = light.groupBy(ID, KEY_A, KEY_B, "fp").agg(F.count("*").alias("copies"))
    order = F.struct(F.col(ID).isNull().alias("null"), ID, KEY_A, KEY_B, "copies")
    least = rows.groupBy("fp").agg(F.min(order).alias("best")).join(label, "fp")
    winners = least.groupBy("label").agg(F.min("best").alias("best")).select(f"best.{ID}", f"best.{KEY_A}", f"best.{KEY_B}", "best.copies")
    return keep_winners(docs, winners, id_col, text_col)
