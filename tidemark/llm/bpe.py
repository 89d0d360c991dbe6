"""Operator 10: byte-level BPE by recursive DuckDB queries in each partition.

A text is split by the vocabulary's pattern.  The words that a partition has
not met yet become rows (word, position, token), one for each byte.  A
recursive query joins adjacent tokens with the merge table, contracts each
word's leftmost pair of least rank, and ends when no word has a pair left.
A document's ids are its words' in order.  As in the library whose ranks are
read, a word that is itself a token stays whole.  Ids are decoded on their own,
whatever text they came from: rows (document, position, id) join the
vocabulary, and ordered aggregation strings the tokens' bytes together.

A word of over ``LONG`` bytes has a query of its own, over a keyed state that
keeps one row for each byte however many rounds it takes; there, all
occurrences of the least pair are contracted together where no pair that this
makes can have a lower rank.

What a worker remembers of earlier words is bounded by ``CACHED``.  The
vocabulary is read where the tokenizer package is installed, its path is a
parameter.

Defined results: a null or empty text has no ids, and the digests of nothing;
repeated rows each get a row; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, small_batches, text_or_empty, worker_cache
from tidemark.llm.parts import Parts, text_blocks

#: Words contracted in one query, and the length from which one has its own.
WORDS, LONG = 30_000, 256
#: Ids decoded in one query.
DECODED = 500_000
#: Words that a Python worker remembers.
CACHED = 400_000
POSITION_BITS = 24
POSITIONS = (1 << POSITION_BITS) - 1

#: Positions stay dense, so a token's right neighbour is one equality join
#: away.  A word without a pair left leaves the recursion as ``done``.
CONTRACT = f"""
WITH RECURSIVE step AS (
    SELECT false AS done, word, pos, tok FROM start
    UNION ALL
    SELECT least IS NULL, t.word,
           CASE WHEN pos > least & {POSITIONS} THEN pos - 1 ELSE pos END,
           CASE WHEN pos = least & {POSITIONS} THEN (least >> {POSITION_BITS})::INT ELSE tok END
    FROM (SELECT word, pos, tok FROM step WHERE NOT done) t
    LEFT JOIN (
        SELECT a.word, min(id::BIGINT << {POSITION_BITS} | a.pos) AS least
        FROM step a
        JOIN step b ON a.word::BIGINT << {POSITION_BITS} | (a.pos + 1) = b.word::BIGINT << {POSITION_BITS} | b.pos
        JOIN merges ON l = a.tok AND r = b.tok
        WHERE NOT a.done AND NOT b.done
        GROUP BY a.word
    ) best ON best.word = t.word
    WHERE least IS NULL OR pos <> (least & {POSITIONS}) + 1
)
SELECT word, tok FROM step WHERE done ORDER BY word, pos
"""

CONTRACT_LONG = """
WITH RECURSIVE step(pos, tok) USING KEY (pos) AS (
    SELECT pos, tok FROM start
    UNION
    SELECT unnest([pos, after]), unnest([id, -1])
    FROM (
        SELECT *, row_number() OVER (PARTITION BY place - nth ORDER BY pos) AS in_run, min(pos) OVER () AS leftmost
        FROM (
            SELECT *, row_number() OVER (ORDER BY pos) AS nth
            FROM (
                SELECT *, min(id) OVER () AS least
                FROM (
                    SELECT pos, tok, lead(tok) OVER o AS mate, lead(pos) OVER o AS after, row_number() OVER o AS place
                    FROM recurring.step WHERE tok >= 0 WINDOW o AS (ORDER BY pos)
                ) JOIN merges ON l = tok AND r = mate
            )
            WHERE id = least
        )
    )
    WHERE CASE WHEN least IN (SELECT id FROM unsafe) THEN pos = leftmost ELSE in_run % 2 = 1 END
)
SELECT 0::INT AS word, tok FROM step WHERE tok >= 0 ORDER BY pos
"""

#: The vocabulary's texts have a sign for each byte.
DECODE = "SELECT row, string_agg(text, '' ORDER BY pos) FROM given JOIN vocabulary ON id = tok GROUP BY row"

#: Merged tokens that can be part of a pair of lower rank than their own.
UNSAFE = """
SELECT a.id FROM merges a JOIN merges b ON b.l = a.id WHERE b.id < a.id
UNION
SELECT a.id FROM merges a JOIN merges b ON b.r = a.id WHERE b.id < a.id
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Words to ids and back, by DuckDB tables ``merges`` (l, r, id),
    ``vocabulary`` (id, text) and ``unsafe`` (id)."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        found = [
            (left, right, whole)
            for token, whole in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None
        ]
        self.db = duckdb.connect(config={"threads": "1", "memory_limit": "500MB", "temp_directory": ""})
        pairs = pa.table(dict(zip("lr", (pa.array([x[i] for x in found], pa.int32()) for i in range(2)))))
        self._table("merges", pairs.append_column("id", pa.array([x[2] for x in found], pa.int32())))
        self._table("vocabulary", pa.table({
            "id": pa.array(list(self.ranks.values()), pa.int32()),
            "text": [token.decode("latin-1") for token in self.ranks],  # a sign for each byte
        }))
        self.db.execute(f"CREATE TABLE unsafe AS {UNSAFE}")
        self.names = [str(i) for i in range(max(self.ranks.values()) + 1)]
        self.words: dict[str, np.ndarray] = {}
        self.parts = Parts(self._part_ids)

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, words: list[str], query: str) -> None:
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        tokens = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        pos = np.arange(len(tokens)) - np.repeat(np.cumsum(size) - size, size)
        word = np.repeat(np.arange(len(raw), dtype=np.int32), size)
        self.db.register("start", pa.table({"word": word, "pos": pos.astype(np.int32), "tok": tokens}))
        found = self.db.execute(query).fetchnumpy()
        self.db.unregister("start")
        of, ids = np.asarray(found["word"]), np.asarray(found["tok"]).astype("<i4")
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for low, high in zip(cuts, cuts[1:]):
            self.words[words[of[low]]] = ids[low:high].copy()

    def learn(self, words: list[str]) -> None:
        short, long = [], []
        for w in words:
            raw = w.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.words[w] = np.array([whole], np.int32)
            else:
                (long if len(raw) > LONG else short).append(w)
        for at in range(0, len(short), WORDS):
            self._contract(short[at:at + WORDS], CONTRACT)
        for w in long:
            self._contract([w], CONTRACT_LONG)

    def _part_ids(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.words) > CACHED:
            self.words.clear()
        found = [self.pattern.findall(p.decode()) for p in parts]
        self.learn(list({w for words in found for w in words} - self.words.keys()))
        known = self.words.__getitem__
        ids = [known(w) for words in found for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        words = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(words)]
        size = np.diff(ends, prepend=0)
        return np.concatenate([np.empty(0, np.int32), *ids]), ends - size, size

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        flat, bounds = self.parts.encode(texts)
        return [flat[low:high] for low, high in zip(bounds, bounds[1:])]

    def digest(self, ids: np.ndarray) -> str:
        """SHA-256 of the ids' decimal text."""
        return hashlib.sha256(" ".join([self.names[i] for i in ids.tolist()]).encode()).hexdigest()

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        """The bytes of each array of ids, by ordered aggregation over blocks
        of ids; an array may go on in the next block."""
        out: list[list[bytes]] = [[] for _ in lists]
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        tokens = np.concatenate([np.empty(0, np.int32), *lists])
        for at in range(0, len(tokens), DECODED):
            own = slice(at, at + DECODED)
            pos = np.arange(len(tokens[own]), dtype=np.int32)
            self.db.register("given", pa.table({"row": row[own], "pos": pos, "tok": tokens[own]}))
            for k, text in self.db.execute(DECODE).fetchall():
                out[k].append(text.encode("latin-1"))
            self.db.unregister("given")
        return [b"".join(x) for x in out]


def encoder(path: str, pattern: str) -> Encoder:
    cache = worker_cache("bpe")
    if (path, pattern) not in cache:
        cache[path, pattern] = Encoder(path, pattern)
    return cache[path, pattern]


def round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, and with
    ``with_ids`` the ids themselves (array) and the decoded bytes."""
    small_batches(docs.sparkSession)
    rows = docs.select(col(id_col).alias("__llm_id"), text_or_empty(text_col).alias("__llm_text"))

    names = ["__llm_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        gc.disable()  # large caches and no cycles: reference counts suffice
        for block in text_blocks(batches, "__llm_text"):
            ids = own.encode(block.column("__llm_text"))
            decoded = own.decode(ids)
            made = [
                block.column("__llm_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([own.digest(x) for x in ids], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
            ]
            if with_ids:
                made += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=names)

    kind = rows.schema["__llm_id"].dataType.simpleString()
    schema = f"__llm_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids
    found = rows.mapInArrow(run, schema)
    return found.withColumnRenamed("__llm_id", id_col)


def decode(rows: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Arrays of ids to their bytes: id, decoded (a null array gives no bytes)."""
    small_batches(rows.sparkSession)
    rows = rows.select(col(id_col).alias("__llm_id"), F.coalesce(col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path, pattern)
        for batch in batches:
            yield pd.DataFrame({"__llm_id": batch["__llm_id"], "decoded": own.decode([np.asarray(x, np.int32) for x in batch["ids"]])})

    kind = rows.schema["__llm_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"__llm_id {kind}, decoded binary").withColumnRenamed("__llm_id", id_col)
