"""Operator 6: best-fit packing by length patterns.

Documents become token ids and a closing id.  One of more than ``size`` ids is
cut into pieces of ``size``, the rest of it first.  What follows needs only
the histogram of piece lengths, at most ``size`` numbers however large the
corpus is.  Patterns of two or three lengths that fill a sequence exactly are
enumerated; non-negative least squares fits how often each is used so that
the histogram is met; the counts are rounded, and the residual lengths are
packed best-fit, longest first, still by count.  Each pattern, repeated, hands
out intervals of ranks: the pieces of one length are ranked in a distributed
way (counts by hash bucket, then a row number inside each bucket), and a
piece's rank says its sequence and offset.

Defined results: a null or empty text is one piece, the closing id alone;
repeated rows are packed once for each row; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import col, small_batches, text_or_empty, worker_cache, written
from tidemark.llm.parts import Parts, joined, text_blocks

#: Pieces in a bucket of a length's ranking, on average at most.
BUCKET_ROWS = 500
#: Bytes of parts that are tokenised in one call.
JOINED = 200_000
#: Buckets of a length whose counts are added up together.
GROUP = 1_000
#: Most bytes of the table of rank intervals that is broadcast, 40 a row; the
#: 87,893 patterns of two or three lengths under 1,024 make 10 MB of them.
SLOT_BYTES = 64 << 20


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Bytes of each token -> id, if the file is a plain byte-level vocabulary
    whose merges, in order, make tokens of rising ids; else None."""
    with open(path, encoding="utf-8") as lines:
        given = json.load(lines)
    model, before = given["model"], given.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and given.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    )
    if not plain:
        return None
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    # The model's signs for bytes: printable ones for themselves.
    sign = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
    added = {t["content"] for t in given.get("added_tokens", [])}
    vocabulary = {token: i for token, i in model["vocab"].items() if token not in added}
    made = [vocabulary["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    if not all(set(t) <= sign.keys() for t in vocabulary) or any(a >= b for a, b in zip(made, made[1:])):
        return None
    if len(made) + 256 != len(vocabulary) or any(c not in vocabulary for c in sign):
        return None
    return {bytes(sign[c] for c in token): i for token, i in vocabulary.items()}


class Ids:
    """Token ids of texts, as the tokenizer's file gives them, asked once for
    each different part.  Added tokens stand for their own strings.

    Where the file's merges make tokens in the order of their ids, as byte-level
    vocabularies do, a pair's rank is the id of what it makes, and the file's
    own vocabulary is run by the faster of the two libraries, with the same
    ids; any other file is run by the tokenizer itself."""

    def __init__(self, path: str, pattern: str):
        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        ranks = ranks_of(path)
        self.ranked = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        added = {t.content: (i, t) for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.added = {content: i for content, (i, _) in added.items()}
        # Longest first: of added tokens that begin at one place, the longest counts.
        self.split = re.compile("(" + "|".join(
            (r"\s*" if t.lstrip else "") + (r"\b" if t.single_word else "") + re.escape(x) + (r"\b" if t.single_word else "") + (r"\s*" if t.rstrip else "")
            for x, (_, t) in sorted(added.items(), key=lambda item: -len(item[0]))
        ) + ")") if added else None
        self.shown = [x.encode() for x in self.added]
        # A token's signs stand for one byte each.
        vocabulary = tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.parts = Parts(self._learn)

    def _learn(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parts are tokenised many at a time, laid end to end; the tokens'
        lengths in bytes tell where one part's end.  A part whose bounds are
        no sure cuts is tokenised alone."""
        flat, done = [], 0
        first, size = np.zeros(len(parts), np.int64), np.full(len(parts), -1, np.int64)
        for which, text, bounds, sure in joined(parts, JOINED):
            ids = np.array(self.encode(text.decode()), np.int32)
            ends = np.concatenate([[0], np.cumsum(self.bytes[ids])])
            at = np.searchsorted(ends, bounds)
            sure &= ends[np.minimum(at, len(ends) - 1)] == bounds
            own = sure[:-1] & sure[1:]
            first[which[own]] = done + at[:-1][own]
            size[which[own]] = np.diff(at)[own]
            flat.append(ids)
            done += len(ids)
        for i in np.flatnonzero(size < 0).tolist():
            ids = np.array(self.encode(parts[i].decode()), np.int32)
            first[i], size[i] = done, len(ids)
            flat.append(ids)
            done += len(ids)
        return np.concatenate([np.empty(0, np.int32), *flat]), first, size

    def encode(self, text: str) -> list[int]:
        if self.ranked is not None:
            return self.ranked.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids end to end, bounds of each text's)."""
        raw = texts.buffers()[2]
        if self.split is None or raw is None or not any(memoryview(raw).tobytes().find(x) >= 0 for x in self.shown):
            return self.parts.encode(texts)
        # Added tokens cut a text; what lies between is encoded as texts of its own.
        pieces, owner, ids_of = [], [], []
        for i, text in enumerate(texts.to_pylist()):
            for k, piece in enumerate(self.split.split(text)):
                owner.append(i)
                ids_of.append(self.added[piece.strip() if piece not in self.added else piece] if k % 2 else -1)
                pieces.append("" if k % 2 else piece)
        flat, bounds = self.parts.encode(pa.array(pieces, pa.string()))
        out = [[] for _ in range(len(texts))]
        for i, own, low, high in zip(owner, ids_of, bounds, bounds[1:]):
            out[i].append(np.array([own], np.int32) if own >= 0 else flat[low:high])
        joined = [np.concatenate(x) for x in out]
        return np.concatenate(joined), np.concatenate([[0], np.cumsum([len(x) for x in joined])])


def pieces(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: __llm_id, piece, start, length, ids_crc32 and, with
    ``with_ids``, the ids."""
    small_batches(docs.sparkSession)
    rows = docs.select(col(id_col).alias("__llm_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["__llm_id"].dataType.simpleString()
    schema = f"__llm_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    names = ["__llm_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("packing")
        if (path, pattern) not in cache:
            cache[path, pattern] = Ids(path, pattern)
        ids = cache[path, pattern]
        gc.disable()  # large caches and no cycles: reference counts suffice
        for block in text_blocks(batches, "text"):
            flat, bounds = ids.texts(block.column("text"))
            # Each text's ids and the closing one, end to end.
            flat = np.insert(flat, bounds[1:], end_id).astype("<i4")
            first = bounds[:-1] + np.arange(len(bounds) - 1)
            total = np.diff(bounds) + 1
            # Only longer texts are cut, into pieces of ``size``, the rest first.
            count = -(-total // size)
            row = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            rest = np.where(total % size == 0, size, total % size)[row]
            start = np.where(piece == 0, 0, rest + (piece - 1) * size)
            length = np.where(piece == 0, rest, size)
            raw = memoryview(flat.tobytes())
            low = first[row] + start
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(low.tolist(), length.tolist())]
            made = [block.column("__llm_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                made.append(pa.ListArray.from_arrays(pa.array(np.append(low, len(flat)), pa.int32()), pa.array(flat, pa.int32())))
            yield pa.RecordBatch.from_arrays(made, names=names)

    return rows.mapInArrow(run, schema)


def exact_patterns(lengths: list[int], size: int) -> np.ndarray:
    """All patterns of two or three of ``lengths`` that add up to ``size``
    (rows of three, ascending, 0 for none)."""
    have = np.array(sorted(x for x in lengths if x < size), np.int64)
    there = np.zeros(size + 1, bool)
    there[have] = True
    low = have[have * 2 <= size]
    twos = low[there[size - low]]
    found = [np.stack([np.zeros_like(twos), twos, size - twos], axis=1)]
    a, b = np.meshgrid(have, have, indexing="ij")
    c = size - a - b
    ok = (a <= b) & (b <= c) & (c > 0)
    ok[ok] = there[c[ok]]
    found.append(np.stack([a[ok], b[ok], c[ok]], axis=1))
    return np.concatenate(found)


def fit_repeats(patterns: np.ndarray, wanted: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 of the patterns, so that the
    lengths they use come near ``wanted`` (accelerated projected gradient on
    the sparse pattern matrix; row 0 stands for an empty place)."""
    if not len(patterns):
        return np.zeros(0)
    size = len(wanted)

    def used(x: np.ndarray) -> np.ndarray:
        total = np.bincount(patterns.ravel(), np.repeat(x, patterns.shape[1]), size)
        total[0] = 0.0
        return total

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns].sum(axis=1)

    # The matrix's largest singular value, by power iteration.
    probe = np.ones(len(patterns))
    for _ in range(20):
        probe = back(used(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    x = y = np.zeros(len(patterns))
    momentum = 1.0
    for _ in range(rounds):
        after = np.maximum(0.0, y - back(used(y) - wanted) / (1.05 * norm))
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = after + (momentum - 1) / faster * (after - x)
        x, momentum = after, faster
    return x


def rounded(patterns: np.ndarray, repeats: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeats, taken from ``left``: the fractions are carried from one
    pattern to the next, and none is used more often than its lengths last."""
    out, carry = [], 0.0
    for k in np.argsort(-repeats, kind="stable"):
        if repeats[k] <= 0:
            break
        carry += repeats[k]
        if carry < 0.5:
            continue
        pattern = tuple(int(x) for x in patterns[k] if x)
        most = min(int(left[x]) // pattern.count(x) for x in pattern)
        n = min(int(carry + 0.5), most)
        if n > 0:
            carry -= n
            for x in pattern:
                left[x] -= n
            out.append((pattern, n))
        else:
            carry = min(carry, 1.0)
    return out


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: sequences alike are one entry."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in range(size, 0, -1):
        todo = int(left[length])
        while todo:
            room = next((r for r in range(length, size) if open_bins.get(r)), None)
            if room is None:
                each = min(size // length, todo)
                n = todo // each
                open_bins[size - each * length].append(((length,) * each, n))
                todo -= each * n
                continue
            content, n = open_bins[room].pop()
            take = min(n, todo)
            if take < n:
                open_bins[room].append((content, n - take))
            open_bins[room - length].append(((*content, length), take))
            todo -= take
    return [x for bins in open_bins.values() for x in bins]


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, how many such sequences), for all pieces."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    out = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    wanted = left[:size].astype(float)
    patterns = exact_patterns([x for x in histogram if histogram[x]], size)
    out += rounded(patterns, fit_repeats(patterns, wanted), left)
    return out + best_fit(left, size)


def _first_ranks(counts: DataFrame) -> DataFrame:
    """(length, bucket, first): how many pieces of a length lie in earlier
    buckets.  Two levels, groups of ``GROUP`` buckets and buckets in a group,
    so the buckets of a common length don't meet in one task."""
    counts = counts.withColumn("group", F.floor(F.col("bucket") / GROUP))

    def earlier(window):
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = counts.groupBy("length", "group").agg(F.sum("n").alias("n"))
    groups = groups.select("length", "group", earlier(Window.partitionBy("length").orderBy("group")).alias("group_first"))
    own = counts.select("length", "group", "bucket", earlier(Window.partitionBy("length", "group").orderBy("bucket")).alias("own_first"))
    return own.join(groups, ["length", "group"]).select("length", "bucket", (F.col("group_first") + F.col("own_first")).alias("first"))


def _slots(spark: SparkSession, planned: list[tuple[tuple[int, ...], int]]) -> tuple[DataFrame, int]:
    """Rank intervals (length, low, high, sequence, offset), and how many.
    Their number depends on the sequence size, not on the corpus."""
    rows, used, sequence = [], defaultdict(int), 0
    for content, n in planned:
        offset = 0
        for length in content:
            rows.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    schema = "length long, low long, high long, sequence long, offset long"
    return spark.createDataFrame(pd.DataFrame(rows, columns=["length", "low", "high", "sequence", "offset"]), schema), len(rows)


def pack(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset (and the ids, with ``with_ids``)."""
    spark = docs.sparkSession
    made = pieces(docs, path, pattern, id_col, text_col, size, end_id, with_ids)
    # A number that stays with a piece once written: it tells equal pieces apart.
    whole = written(made.withColumn("__llm_row", F.monotonically_increasing_id()) if with_ids else made, "pieces")
    cut = whole.drop("ids")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    most = max(histogram.values(), default=0)
    keys = ["__llm_id", "piece", "start", "ids_crc32"]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(-(-most // BUCKET_ROWS) or 1)).cast("long")
    dealt = cut.withColumn("bucket", bucket)
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    firsts = _first_ranks(counts)
    within = Window.partitionBy("length", "bucket").orderBy(*keys)
    ranked = (
        dealt.withColumn("nth", F.row_number().over(within))
        .join(firsts, ["length", "bucket"])
        .withColumn("rank", F.col("first") + F.col("nth") - 1)
    )
    slots, n_slots = _slots(spark, plan(histogram, size))
    slots = (F.broadcast(slots) if 40 * n_slots <= SLOT_BYTES else slots).alias("s")
    r = ranked.alias("r")
    placed = r.join(
        slots,
        (F.col("r.length") == F.col("s.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    out = placed.select(
        F.col("__llm_id").alias(id_col), "piece", "start", F.col("r.length").alias("length"), "ids_crc32",
        (F.col("s.sequence") + F.col("rank") - F.col("low")).alias("sequence_id"),
        "offset", *(["__llm_row"] if with_ids else []),
    )
    # Ranks are found on light rows; the ids move once, to their places.
    return out.join(whole.select("__llm_row", "ids"), "__llm_row").drop("__llm_row") if with_ids else out
