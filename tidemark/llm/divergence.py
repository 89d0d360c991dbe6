"""Operator 11: how the sources of a language differ in their words.

Terms are packed by length: one of up to 8 UTF-8 bytes becomes one uint64
word, one of up to 16 two; longer ones stay bytes.  A block of texts is one
byte array: runs of letters are cut out with numpy, their words gathered, and
each length bucket is sorted and counted on its own - words by a radix sort of
16-bit digits (stable, so a term's documents stay in order and are counted by
their changes), long terms as bytes.  A partition's counts are merged, by the
same sort, before they leave it: one row per (language, source, term), with
occurrences and documents.

Spark adds them up, twice (by language, source and term, then by language and
term), keeps the terms of enough documents, and gives each group and language
its smoothed integer share ``p``.  The pairs' sums are dealt by (language,
bucket of terms, tile of sources, tile of sources): a task adds up a block of
terms by sources as a matrix, in which an absent term has its source's least
share, and leaves one number per pair of sources.  Tiles hold about ``TILE``
sources, buckets about ``BUCKET`` counts, so neither a hot language nor a hot
source grows a task.

All arithmetic is in integers, that of shares in 38-digit decimals.

Defined results: null text, lang or source count as empty; each row is a
document, repeated rows too; a language without kept terms has pair rows of
value 0 and no term rows; a language with one source has no pair rows; equal
values are ranked by the item's UTF-8 bytes; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty, written
from tidemark.operators.lookups import bounded_broadcast

#: Bytes of text in a block, and terms a partition holds before it passes them on.
BLOCK, HELD = 8_000_000, 1_000_000
#: Sources in a tile of the pair sums, and counts in a bucket at least, about.
TILE, BUCKET = 128, 2_000
#: Cells (terms by sources by sources) of one step of a pair sum.
CELLS = 2_000_000
SCALE = 1_000_000_000

#: A byte's place in a term: 0 for none, else the byte that counts for it.
FOLD = np.zeros(256, np.uint8)
FOLD[0x80:] = np.arange(0x80, 0x100)
FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


# --- packed terms ------------------------------------------------------------

def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by unsigned keys, the most significant first:
    one counting pass for each 16-bit digit that isn't the same in all rows."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        digits = np.ascontiguousarray(key).view(np.uint16).reshape(len(key), key.itemsize // 2)  # least significant first
        for d in range(digits.shape[1]):
            digit = digits[:, d]
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


class Counts:
    """Terms of one length bucket with their group, occurrences and documents,
    sorted: ``words`` are its uint64 words, or one array of bytes objects."""

    def __init__(self, group: np.ndarray, words: list[np.ndarray], n: np.ndarray, docs: np.ndarray):
        self.group, self.words, self.n, self.docs = group, words, n, docs

    def __len__(self) -> int:
        return len(self.group)

    @staticmethod
    def order(group: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
        if words[0].dtype == object:  # sorted by their bytes, then stably by group
            order = np.argsort(words[0], kind="stable")
            return order[radix_order([group[order]])]
        return radix_order([group, *words])

    @classmethod
    def runs(cls, group: np.ndarray, words: list[np.ndarray], doc: np.ndarray) -> "Counts":
        """Occurrences, in document order, run-counted."""
        order = cls.order(group, words)
        group, words, doc = group[order], [w[order] for w in words], doc[order]
        new = cls.starts(group, words)
        at = np.flatnonzero(new)
        fresh = new.copy()  # a document's first occurrence of the term
        fresh[1:] |= doc[1:] != doc[:-1]
        return cls(group[at], [w[at] for w in words], np.diff(np.append(at, len(group))), np.add.reduceat(fresh, at, dtype=np.int64) if len(at) else at)

    @staticmethod
    def starts(group: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        for w in words:
            new[1:] |= w[1:] != w[:-1]
        return new

    @classmethod
    def merged(cls, parts: list["Counts"], one_document: bool = False) -> "Counts":
        """Counts added up; ``one_document``: all are of the same one."""
        group = np.concatenate([p.group for p in parts])
        words = [np.concatenate(x) for x in zip(*[p.words for p in parts])]
        n, docs = (np.concatenate([getattr(p, x) for p in parts]) for x in ("n", "docs"))
        order = cls.order(group, words)
        group, words = group[order], [w[order] for w in words]
        at = np.flatnonzero(cls.starts(group, words))
        if not len(at):
            return cls(group, words, n, docs)
        docs = np.ones(len(at), np.int64) if one_document else np.add.reduceat(docs[order], at)
        return cls(group[at], [w[at] for w in words], np.add.reduceat(n[order], at), docs)


def _words(folded: np.ndarray, start: np.ndarray, length: np.ndarray, word: int) -> np.ndarray:
    """The ``word``-th 8 bytes of each term as one number, big-endian, so that
    numbers sort as bytes do; missing bytes are zero."""
    out = np.zeros(len(start), np.uint64)
    for k in range(8 * word, 8 * word + 8):
        there = length > k
        byte = np.where(there, folded[np.minimum(start + k, len(folded) - 1)], 0)
        out = (out << np.uint64(8)) | byte.astype(np.uint64)
    return out


def count_terms(data: np.ndarray, ends: np.ndarray, group: np.ndarray) -> list[Counts]:
    """Texts laid end to end (``ends``: where each ends) -> the counts of the
    three length buckets."""
    folded = FOLD[data]
    inside = folded > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = ends[(ends > 0) & (ends < len(data))]  # a text's end ends its term
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - start
    doc = np.searchsorted(ends, start, side="right")
    out = []
    for words, own in ((1, length <= 8), (2, (length > 8) & (length <= 16)), (0, length > 16)):
        at, size = start[own], length[own]
        if words:
            packed = [_words(folded, at, size, w) for w in range(words)]
        else:
            raw = folded.tobytes()
            packed = [np.empty(len(at), object)]
            packed[0][:] = [raw[a:a + n] for a, n in zip(at.tolist(), size.tolist())]
        out.append(Counts.runs(group[doc[own]], packed, doc[own]))
    return out


def _slices(data: np.ndarray) -> Iterator[np.ndarray]:
    """A very long text in parts of about ``BLOCK`` bytes, cut between terms."""
    at = 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data) and FOLD[data[end]] and FOLD[data[end - 1]]:
            end += 1
        yield data[at:end]
        at = end


class Tally:
    """The counts of one partition; groups are numbered as they come."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[list[Counts]] = []
        self.held = 0

    def add(self, langs: list[str], sources: list[str], texts: pa.Array) -> None:
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in zip(langs, sources)], np.uint32)
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)
        offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        row = 0
        while row < len(texts):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1)
            own = data[offsets[row]:offsets[end]]
            if end == row + 1 and len(own) > BLOCK:
                pieces = [count_terms(x, np.array([len(x)]), group[row:end]) for x in _slices(own)]
                self._hold([Counts.merged(list(p), one_document=True) for p in zip(*pieces)])
            elif len(own):
                self._hold(count_terms(own, offsets[row + 1:end + 1] - offsets[row], group[row:end]))
            row = end

    def _hold(self, counts: list[Counts]) -> None:
        self.parts.append(counts)
        self.held += sum(map(len, counts))
        if self.held > HELD:
            self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            self.parts = [[Counts.merged(list(p)) for p in zip(*self.parts)]]
        self.held = sum(len(c) for p in self.parts for c in p)

    def full(self) -> bool:
        return self.held > HELD

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(lang, source, a, b, tail, n, docs), and a fresh start."""
        self.merge()
        names = list(self.groups)
        lang, source = (pa.array([x[i] for x in names], pa.string()) for i in range(2))
        for part in self.parts:
            for c in part:
                for at in range(0, len(c), 50_000):
                    own = slice(at, at + 50_000)
                    group = pa.array(c.group[own].astype(np.int64))
                    size = len(group)
                    long = c.words[0].dtype == object
                    ab = [pa.array(w[own].view(np.int64)) for w in c.words] if not long else []
                    yield pa.RecordBatch.from_arrays(
                        [lang.take(group), source.take(group), *ab, *[pa.nulls(size, pa.int64())] * (2 - len(ab)),
                         pa.array(c.words[0][own], pa.binary()) if long else pa.nulls(size, pa.binary()),
                         pa.array(c.n[own]), pa.array(c.docs[own])],
                        names=["lang", "source", "a", "b", "tail", "n", "docs"],
                    )
        self.parts, self.held, self.groups = [], 0, {}


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally()
    for batch in batches:
        tally.add(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"))
        if tally.full():
            yield from tally.rows()
    yield from tally.rows()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, a, b, tail, n, docs), added up: a and b are a short
    term's words, tail a long term's bytes."""
    rows = docs.select(*[text_or_empty(c).alias(x) for c, x in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    found = rows.mapInArrow(_tally, "lang string, source string, a long, b long, tail binary, n long, docs long")
    return found.groupBy("lang", "source", *TERM).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


TERM = ("a", "b", "tail")


def term_text() -> Column:
    """A packed term as a string."""
    def word(name: str) -> Column:
        return F.coalesce(F.lpad(F.hex(name), 16, "0"), F.lit(""))

    packed = F.unhex(F.regexp_replace(F.concat(word("a"), word("b")), "(00)+$", ""))
    return F.decode(F.coalesce("tail", packed), "UTF-8")


# --- shares and divergences --------------------------------------------------

def _div(a: Column, b: Column) -> Column:
    """The whole part of a quotient."""
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), in wide decimals."""
    wide = [x.cast("decimal(19,0)") for x in (count + 2, total + 2 * kept)]
    return 1 + _div(F.lit(SCALE).cast("decimal(10,0)") * wide[0], wide[1])


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _pair_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """One (language, bucket, tile, tile): headers (each source and its absent
    share) and counted terms -> one row per pair of sources."""
    head = rows[rows["n_kept"].notna()].sort_values("source")
    terms = rows[rows["n_kept"].isna()]
    left, right = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
    names = head["source"].to_numpy()
    absent = head["p"].to_numpy(np.int64)
    place = {x: i for i, x in enumerate(names)}
    tile = head["tile"].to_numpy()
    a, b = np.flatnonzero(tile == left), np.flatnonzero(tile == right)
    sums = np.zeros((len(a), len(b)), np.int64)

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        gap = p - q
        return gap * gap // np.maximum(p + q, 1)

    number = terms["term"].to_numpy(np.int64)
    at = np.fromiter(map(place.__getitem__, terms["source"]), np.int64, len(terms))
    p = terms["p"].to_numpy(np.int64)
    present = int(number.max()) + 1 if len(number) else 0
    order = np.argsort(number, kind="stable")
    number, at, p = number[order], at[order], p[order]
    step = max(1, CELLS // max(1, len(a) * len(b)))
    for low in range(0, present, step):
        own = slice(*np.searchsorted(number, [low, low + step]))
        matrix = np.tile(absent, (min(step, present - low), 1))
        matrix[number[own] - low, at[own]] = p[own]
        sums += f(matrix[:, a][:, :, None], matrix[:, b][:, None, :]).sum(axis=0)
    none = f(absent[a][:, None], absent[b][None, :])
    i, j = np.nonzero(np.ones_like(sums) if left != right else np.triu(np.ones_like(sums), 1))
    return pd.DataFrame({
        "lang": rows["lang"].iloc[0], "source": names[a[i]], "item": names[b[j]], "value": sums[i, j], "present": present,
        "absent": none[i, j], "n_kept": int(head["n_kept"].iloc[0]) if len(head) else 0,
    })


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", documents: int = 10, best: int = 10,
) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for each other
    source of the language, ``term`` rows for the ``best`` terms of which a
    source has more than its language."""
    counts = term_counts(docs, text_col, lang_col, source_col)
    whole = Window.partitionBy("lang", *TERM)  # a term's sources
    kept = written(
        counts.withColumns({
            "in_docs": F.sum("docs").over(whole), "total": F.sum("n").over(whole),
            "lead": (F.row_number().over(whole.orderBy("source")) == 1).cast("int"),
        }).filter(F.col("in_docs") >= documents).drop("in_docs", "docs"),
        "kept-terms",
    )
    group = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    group = group.join(own, ["lang", "source"], "left").withColumn("own", F.coalesce("own", F.lit(0).cast("long")))
    langs = kept.groupBy("lang").agg(F.sum("lead").alias("n_kept"), F.sum("n").alias("all"), F.count("*").alias("cells"))
    sources = group.groupBy("lang").agg(F.count("*").alias("n_sources")).join(langs, "lang", "left").na.fill(0, ["n_kept", "all", "cells"])
    tiles = F.ceil(F.col("n_sources") / TILE).cast("long")
    # A bucket has at least as many counts as pairs of sources it leaves.
    bucket = F.greatest(F.lit(BUCKET), F.pow(F.least("n_sources", F.lit(TILE)), 2).cast("long"))
    groups = written(
        group.join(sources, "lang").withColumns({
            "tiles": tiles, "tile": F.pmod(F.xxhash64("source"), tiles),
            "buckets": F.greatest(F.lit(1).cast("long"), F.ceil(F.col("cells") / bucket).cast("long")),
            "absent": F.when(F.col("n_kept") > 0, share(F.lit(0).cast("long"), F.col("own"), F.col("n_kept"))).otherwise(F.lit(0).cast("long")),
        }),
        "groups",
    )
    rows = kept.join(bounded_broadcast(groups), ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("own"), F.col("n_kept")), "q": share(F.col("total"), F.col("all"), F.col("n_kept")),
    })
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = (
        rows.filter("p > q").select("lang", "source", term_text().alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    )
    term = F.struct(*TERM)
    dealt = rows.select("lang", "source", "tile", "tiles", "p", term.alias("t"), F.pmod(F.xxhash64(*TERM), F.col("buckets")).alias("bucket"), F.lit(None).cast("long").alias("n_kept"))
    heads = groups.filter("n_sources > 1").select(
        "lang", "source", "tile", "tiles", F.col("absent").alias("p"), F.lit(None).cast(dealt.schema["t"].dataType).alias("t"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"), "n_kept",
    )
    both = dealt.unionByName(heads).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("mate")).withColumns({
        "low": F.least("tile", "mate"), "high": F.greatest("tile", "mate"),
    })
    key = ["lang", "bucket", "low", "high"]
    # Terms of a bucket are numbered from 0; headers have no term.
    numbered = both.withColumn("term", F.dense_rank().over(Window.partitionBy(*key).orderBy(F.col("t").asc_nulls_last())) - 1)
    sums = numbered.select(*key, "source", "tile", "p", "term", "n_kept").groupBy(*key).applyInPandas(
        _pair_sums, "lang string, source string, item string, value long, present long, absent long, n_kept long"
    )
    added = sums.groupBy("lang", "source", "item").agg(
        (F.sum("value") + (F.max("n_kept") - F.sum("present")) * F.max("absent")).alias("value")
    )
    pairs = added.unionByName(added.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    parts = [x.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long"), F.col("rank").cast("int")) for part, x in (("pair", pairs), ("term", more))]
    return parts[0].unionByName(parts[1])
