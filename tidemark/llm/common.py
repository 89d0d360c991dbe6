"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: White space that the exact and near-duplicate contracts ignore or split at.
ASCII_SPACE = r"[\x20\x09-\x0D]"

#: Rows handed to a Python worker at once.  Texts may be long, so a batch is
#: kept far below Spark's default of 10,000 rows.
BATCH_ROWS = 500


def col(name: str) -> Column:
    """A column by its exact name (dots and other signs are not a path)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker: no more than ``BATCH_ROWS`` rows
    in one Arrow batch, unless the session asks for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the cluster's shared scratch folder
    and read back: its rows are computed once, its lineage ends here, and a
    lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders that :func:`written` made and :func:`release` has not removed.
_written: list[str] = []


def mark() -> int:
    """A point in the list of written folders, for :func:`release`."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Removes the folders that :func:`written` made after a :func:`mark`, but
    for the last ``keep``: for a caller whose own result is written, so that
    nothing reads them any more."""
    gone = _written[since:len(_written) - keep]
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _written.remove(path)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process, so that
    the tasks it runs share what is costly to set up."""
    module = sys.modules.setdefault("_tidemark_worker_cache", types.ModuleType("_tidemark_worker_cache"))
    return module.__dict__.setdefault(name, {})


def shared(spark: SparkSession, value):
    """A broadcast of ``value`` that workers can read without this package
    (its classes travel with it); the size of ``value`` must be bounded."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def value_of(broadcast):
    """The value of :func:`shared`, unpacked once per worker process."""
    cache, packed = worker_cache("shared"), broadcast.value
    key = (len(packed), hash(packed))
    if key not in cache:
        cache.clear()
        cache[key] = cloudpickle.loads(packed)
    return cache[key]


#: Names of the row-key columns that :func:`keyed` adds.
ID, KEY_A, KEY_B, COPIES = "__llm_id", "__llm_a", "__llm_b", "__llm_copies"


def keyed(text_col: str) -> list[Column]:
    """128 bits of the raw text; with the id they tell rows apart."""
    text = text_or_empty(text_col)
    return [F.xxhash64(text).alias(KEY_A), F.xxhash64(F.lit(1), text).alias(KEY_B)]


def keep_winners(docs: DataFrame, winners: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``winners`` (ID, KEY_A, KEY_B, copies) names,
    with all their columns.  The texts are shuffled once, by id, so no group
    of copies meets in one task.  Of rows that share id and text one stays:
    the one whose columns, as JSON, hash lowest (an aggregate, combined
    before the shuffle)."""
    columns = docs.columns
    rows = docs.withColumns({ID: col(id_col)}).select("*", *keyed(text_col)).alias("d")
    w = winners.withColumnRenamed("copies", COPIES).alias("w")
    kept = rows.join(
        w,
        F.col(f"d.{ID}").eqNullSafe(F.col(f"w.{ID}"))
        & (F.col(f"d.{KEY_A}") == F.col(f"w.{KEY_A}"))
        & (F.col(f"d.{KEY_B}") == F.col(f"w.{KEY_B}")),
    ).select("d.*", f"w.{COPIES}")
    whole = F.struct(*[col(c) for c in columns])
    once = kept.filter(F.col(COPIES) == 1).select(*[col(c) for c in columns])
    several = (
        kept.filter(F.col(COPIES) > 1)
        .groupBy(ID, KEY_A, KEY_B)
        .agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("row"))
        .select(*[F.col("row").getField(c).alias(c) for c in columns])
    )
    return once.unionByName(several)
