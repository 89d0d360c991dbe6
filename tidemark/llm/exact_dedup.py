"""Operator 8: exact deduplication through content-defined chunk recipes.

A text without its ASCII white space is cut where its own characters say so
(after a fixed kind of letter triple, between 256 and 2,048 characters).  Each
chunk gets a 128-bit identifier.  The identifiers are verified: all distinct
chunks are brought together once by identifier, and if any identifier has two
different chunks, another seed is tried.  A document's recipe is the ordered
list of its chunks' identifiers, so two texts are equal exactly when their
recipes are.  Long texts move once, as chunks that are already combined where
they were read; everything after that works on recipes.

DataFrame functions only.  Groups are counted with aggregates that combine
before the shuffle; the decision returns to the rows by a join that adaptive
execution splits where one recipe is hot.

Defined results: a null text counts as empty, and all empty texts are one
group; of equal texts the one with the most code points stays, then the
smallest id (a null id last), then the lower hash of the raw text; of repeated
rows (id and text alike) one is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ID, KEY_A, KEY_B, col, keep_winners, keyed, text_or_empty, written

SHORTEST, LONGEST = 256, 2048


def _letters(rest: int) -> str:
    """A character class: the Latin-1 letters whose code is ``rest`` modulo 8."""
    return "[" + "".join(chr(c) for c in range(0x41, 0x100) if c % 8 == rest and chr(c).isalpha()) + "]"


#: A chunk ends after three letters of fixed kinds, or at its greatest length.
CHUNK = (
    f"(?s).{{{SHORTEST},{LONGEST - 3}}}?{_letters(5)}{_letters(4)}{_letters(1)}"
    f"|.{{1,{LONGEST}}}"
)


def normalised(text_col: str) -> Column:
    return F.translate(text_or_empty(text_col), " \t\n\x0b\x0c\r", "")


def chunks(text_col: str) -> Column:
    return F.regexp_extract_all(normalised(text_col), F.lit(CHUNK), F.lit(0))


def chunk_id(chunk: Column, seed: int) -> list[Column]:
    """128 bits of a chunk, as two longs."""
    return [F.xxhash64(F.lit(2 * seed), chunk), F.xxhash64(F.lit(2 * seed + 1), chunk)]


Identify = Callable[[Column, int], list[Column]]


def verified_seed(docs: DataFrame, text_col: str, identify: Identify = chunk_id) -> int:
    """The first seed for which no two different chunks share an identifier."""
    pieces = docs.select(F.explode(chunks(text_col)).alias("chunk"))
    seed = 0
    while True:
        a, b = identify(F.col("chunk"), seed)
        distinct = pieces.select(a.alias("a"), b.alias("b"), "chunk").groupBy("a", "b", "chunk").agg(F.lit(1))
        shared = distinct.groupBy("a", "b").count().filter("count > 1").agg(F.count("*")).first()[0]
        if not shared:
            return seed
        seed += 1


def recipes(docs: DataFrame, id_col: str, text_col: str, identify: Identify = chunk_id) -> DataFrame:
    """Light rows, written once: id, raw-text key, recipe, length, digest, and
    how many rows are alike in all of these."""
    seed = verified_seed(docs, text_col, identify)
    recipe = F.flatten(F.transform(chunks(text_col), lambda c: F.array(*identify(c, seed))))
    return written(
        docs.select(
            col(id_col).alias(ID),
            *keyed(text_col),
            recipe.alias("recipe"),
            F.char_length(text_or_empty(text_col)).alias("n_chars"),
            F.sha2(normalised(text_col), 256).alias("text_sha256"),
        )
        .groupBy(ID, KEY_A, KEY_B, "recipe", "n_chars", "text_sha256")
        .agg(F.count("*").alias("copies")),
        "recipes",
    )


def _best(rows: DataFrame) -> DataFrame:
    order = F.struct((-F.col("n_chars")).alias("n"), F.col(ID).isNull().alias("null"), ID, KEY_A, KEY_B)
    return rows.groupBy("recipe").agg(F.min(order).alias("best"), F.sum("copies").alias("group_size"))


def _wins() -> Column:
    return (
        F.col(f"best.{ID}").eqNullSafe(F.col(ID))
        & (F.col(f"best.{KEY_A}") == F.col(KEY_A))
        & (F.col(f"best.{KEY_B}") == F.col(KEY_B))
    )


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identify: Identify = chunk_id) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, id_col, text_col, identify)
    # Written, so that both sides of the join are plain exchanges and adaptive
    # execution can split a hot recipe.
    joined = rows.join(written(_best(rows), "best"), "recipe")
    each = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return each.select(
        F.col(ID).alias(id_col),
        F.col(f"best.{ID}").alias("keep_id"),
        "group_size",
        (_wins() & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identify: Identify = chunk_id) -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    rows = recipes(docs, id_col, text_col, identify)
    best = _best(rows).select("best.*")
    copies = rows.select(ID, KEY_A, KEY_B, "copies")
    winners = best.alias("b").join(
        copies.alias("c"),
        F.col(f"b.{ID}").eqNullSafe(F.col(f"c.{ID}"))
        & (F.col(f"b.{KEY_A}") == F.col(f"c.{KEY_A}"))
        & (F.col(f"b.{KEY_B}") == F.col(f"c.{KEY_B}")),
    ).select("c.*")
    return keep_winners(docs, winners, id_col, text_col)
