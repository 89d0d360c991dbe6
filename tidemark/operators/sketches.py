"""Approximate aggregates (C1, C2): mergeable sketches, map-side combined.

The sketches are binary columns (the histograms arrays) of bounded size: they
are stored per fine group, such as domain and day, and merged to coarser ones
without the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def approx_distinct(df: DataFrame, group_cols, value_col: str, rsd: float = 0.02, alias: str = "approx_distinct") -> DataFrame:
    """HyperLogLog++ distinct count per group."""
    return df.groupBy(*group_cols).agg(F.approx_count_distinct(value_col, rsd).alias(alias))


def hll_sketches(df: DataFrame, group_cols, value_col: str, lg_k: int = 12) -> DataFrame:
    """Binary HLL sketches per group, to be stored and merged later."""
    return df.groupBy(*group_cols).agg(F.hll_sketch_agg(value_col, lg_k).alias("sketch"))


def merge_hll(sketches: DataFrame, group_cols, alias: str = "approx_distinct") -> DataFrame:
    """Union stored sketches (e.g. days -> month) and estimate."""
    return sketches.groupBy(*group_cols).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(alias)
    )


def approx_quantiles(df: DataFrame, group_cols, value_col: str, probs=(0.5, 0.9, 0.99), accuracy: int = 10_000) -> DataFrame:
    """Quantiles per group from a bounded-size summary."""
    q = F.percentile_approx(value_col, list(probs), accuracy)
    return df.groupBy(*group_cols).agg(
        *[q[i].alias(f"p{int(round(p * 100))}") for i, p in enumerate(probs)]
    )


def approx_histogram(df: DataFrame, group_cols, value_col: str, bins: int = 10) -> DataFrame:
    """Equi-height histogram per group (``histogram_numeric``)."""
    return df.groupBy(*group_cols).agg(
        F.histogram_numeric(F.col(value_col), F.lit(bins)).alias("histogram")
    )


def theta_sketches(df: DataFrame, group_cols, value_col: str, lg_nom_entries: int = 12) -> DataFrame:
    """Theta sketches per group; unlike HLL they support intersection
    and difference as well as union."""
    return df.groupBy(*group_cols).agg(F.theta_sketch_agg(value_col, lg_nom_entries).alias("sketch"))


def theta_overlap(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Per key of ``on``, estimated distinct values in both sketch sets,
    in the left only, and in either.  Inputs hold one sketch per key (from
    ``theta_sketches``), so the join moves sketches, not values."""
    l = left.withColumnRenamed("sketch", "_l")
    r = right.withColumnRenamed("sketch", "_r")
    joined = l.join(r, on=on, how="inner")
    return joined.select(
        *([on] if isinstance(on, str) else on),
        F.theta_sketch_estimate(F.theta_intersection("_l", "_r")).alias("in_both"),
        F.theta_sketch_estimate(F.theta_difference("_l", "_r")).alias("left_only"),
        F.theta_sketch_estimate(F.theta_union("_l", "_r")).alias("in_either"),
    )


# --- C1: quantile sketches -----------------------------------------------------

def kll_sketches(df: DataFrame, group_cols, value_col: str, k: int = 800) -> DataFrame:
    """A quantile sketch (KLL, doubles) per group, to be stored and merged
    later.  Nulls are left out; a group without values has no row.  ``k`` sets
    size and error: see :func:`kll_rank_bound`."""
    values = df.where(F.col(value_col).isNotNull())
    return values.groupBy(*group_cols).agg(F.kll_sketch_agg_double(F.col(value_col).cast("double"), k).alias("sketch"))


def merge_kll(sketches: DataFrame, group_cols, k: int = 800) -> DataFrame:
    """Stored sketches of fine groups -> one per coarser group (days ->
    month, domains -> all with no columns).  Merging is an aggregate, combined
    before its shuffle: a group moves one sketch per task."""
    return sketches.groupBy(*group_cols).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def kll_quantiles(sketches: DataFrame, probs=(0.5, 0.9, 0.99), sketch_col: str = "sketch") -> DataFrame:
    """Number of values and estimated quantiles (``p50`` ...) beside the
    group columns."""
    others = [c for c in sketches.columns if c != sketch_col]
    return sketches.select(
        *others, F.kll_sketch_get_n_double(sketch_col).alias("n_values"),
        *[F.kll_sketch_get_quantile_double(sketch_col, F.lit(float(p))).alias(quantile_name(p)) for p in probs],
    )


def kll_rank(sketch_col: str, value):
    """Estimated share of a sketch's values up to ``value``."""
    return F.kll_sketch_get_rank_double(sketch_col, value)


def quantile_name(p: float) -> str:
    return "p" + f"{100 * p:g}".replace(".", "_")


def kll_rank_bound(k: int = 800) -> float:
    """The sketch's published error bound: the rank of an estimated quantile
    is off by at most this share of the values, with 99 % confidence."""
    return 2.296 / k**0.9021


# --- C2: fixed-bucket histograms -------------------------------------------------

def fixed_histograms(df: DataFrame, group_cols, value_col: str, lower: float, upper: float, buckets: int) -> DataFrame:
    """Per group ``counts``, an array of ``buckets + 2``: values under
    ``lower``, those of each bucket ``[low, high)``, values from ``upper`` on
    (a NaN counts there); and ``n_null``.  Counted per bucket first, so a hot
    group moves at most one row per bucket and task."""
    value = F.col(value_col).cast("double")
    width = (upper - lower) / buckets
    inner = F.least(F.floor((value - lower) / width).cast("long"), F.lit(buckets - 1).cast("long"))
    place = (
        F.when(value.isNull(), -1).when(F.isnan(value) | (value >= upper), buckets + 1).when(value < lower, 0)
        .otherwise(inner + 1).cast("int")
    )
    counted = df.groupBy(*group_cols, place.alias("_place")).agg(F.count(F.lit(1)).alias("_n"))
    return _as_arrays(counted, group_cols, buckets)


def _as_arrays(counted: DataFrame, group_cols, buckets: int) -> DataFrame:
    entries = F.map_from_entries(F.collect_list(F.struct("_place", "_n")))  # buckets + 3 at most
    got = counted.groupBy(*group_cols).agg(entries.alias("_m"))

    def of(place):
        return F.coalesce(F.try_element_at("_m", place), F.lit(0).cast("long"))

    return got.select(
        *group_cols, F.transform(F.sequence(F.lit(0), F.lit(buckets + 1)), of).alias("counts"), of(F.lit(-1)).alias("n_null")
    )


def merge_fixed(histograms: DataFrame, group_cols, buckets: int) -> DataFrame:
    """Histograms of fine groups with the same buckets -> coarser ones."""
    parts = histograms.select(*group_cols, F.posexplode("counts").alias("_place", "_n")).unionByName(
        histograms.select(*group_cols, F.lit(-1).alias("_place"), F.col("n_null").alias("_n"))
    )
    return _as_arrays(parts.groupBy(*group_cols, "_place").agg(F.sum("_n").alias("_n")), group_cols, buckets)


def fixed_quantile(counts, p: float, lower: float, upper: float, buckets: int):
    """A quantile from ``counts``: linear inside its bucket; in the
    outliers the bound they lie beyond; null without values."""
    counts = F.col(counts) if isinstance(counts, str) else counts
    width = (upper - lower) / buckets
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    wanted = total * F.lit(float(p))
    zero = F.struct(F.lit(0).cast("long").alias("before"), F.lit(-1).alias("place"), F.lit(0.0).alias("found"), F.lit(False).alias("done"))

    def step(a, x):
        place = a["place"] + 1
        here = ~a["done"] & (x > 0) & ((a["before"] + x) >= wanted)
        inside = F.lit(lower) + width * (place - 1) + width * (wanted - a["before"]) / F.greatest(x, F.lit(1))
        at = F.when(place == 0, F.lit(float(lower))).when(place == buckets + 1, F.lit(float(upper))).otherwise(inside)
        return F.struct((a["before"] + x).alias("before"), place.alias("place"), F.when(here, at).otherwise(a["found"]).alias("found"), (a["done"] | here).alias("done"))

    return F.when(total > 0, F.aggregate(counts, zero, step)["found"])
