"""Cleaning and packing a training corpus: the stages, in order.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, langid, packing, secret_scan, simhash
from tidemark.llm.common import mark, release, written
from tidemark.sources.tables import table_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the others go."""
    return langid.keep_identified(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.deduplicate(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays: shingles of three
    words, fingerprints at two or fewer differing bits."""
    return simhash.deduplicate(docs, shingle_words=3, max_bits=2)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return secret_scan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1,024 ids, one row per piece, with its ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scan_stage),
    ("best-fit packing", best_fit_packing),
]

#: The stages train a classifier, hash n-grams and tokenise: no SQL says that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    since = mark()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark, since, keep=1)  # the stage before it and what this one wrote on its way
    return docs
