"""Operator 12: trie of conversation prefixes, as balanced parentheses.

A conversation is rebuilt and becomes a path of 16-byte turn digests.  Paths
are sorted and range-partitioned into shards; a shard is a block of sorted
paths.  Depth-first, a block's trie is one sequence of parentheses: a node
opens, its subtree follows, it closes.  Range minima over blocks of the excess
(opened minus closed) answer ``findclose``, which delimits each subtree; the
rank of leaf pairs ``()`` between its ends counts leaves; cumulative arrays in
preorder give members and savings, range minima the smallest member.

A node whose members all lie inside one block is complete there.  Only the
prefixes of a block's first and last path, its spines, can go on in another
block.  They leave the block as at most two weighted paths that carry, for
each depth, what hangs off that node outside the spines.  Weighted paths are
paths again: they are sorted, dealt and encoded by the same code, a thousand
times fewer in each round, until one block holds them all and is complete.
So a third of all conversations may be copies of one or share their first
turn: copies are dealt over blocks by their id, and their nodes are merged as
spines.  The ids that end at such a node are joined block by block in texts of
at most ``ROWS`` ids; those texts, in order, go through one running digest,
which holds nothing but its state.

A turn's digest is the first half of SHA-256 over its role and text.  What
meets in one task is a conversation's own digests, not its texts.

Defined results: a row without conv_id takes no part; a null role or text is
empty; rows with the same conv_id and turn are ordered by the SHA-256 of role
and text, and repeated rows are turns of their own; a negative id's remainder
has its sign; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, written

#: Paths in a block, conversations and weighted ones, and turns in a block
#: that has at least four paths.
ROWS, WEIGHTED, TURNS = 20_000, 2_000, 1_000_000
#: Positions in a block of the excess sequence.
SPAN = 64
#: Bytes of a turn's digest.
TOKEN = 16


# --- balanced parentheses ----------------------------------------------------

class Parentheses:
    """A sequence of balanced parentheses (1 opens, 0 closes)."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.opens = np.flatnonzero(bits)
        excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        self.excess = excess
        blocks = -(-len(excess) // SPAN)
        size = 1 << max(0, blocks - 1).bit_length()
        padded = np.full(size * SPAN, np.iinfo(np.int64).max)
        padded[:len(excess)] = excess
        self.rows = padded.reshape(size, SPAN)
        self.minima = [self.rows.min(axis=1)]  # of blocks, then of pairs of them, ...
        while len(self.minima[-1]) > 1:
            self.minima.append(self.minima[-1].reshape(-1, 2).min(axis=1))
        leaf = np.zeros(len(bits) + 1, np.int64)
        leaf[1:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.leaf_rank = np.cumsum(leaf)  # leaf pairs that open before a position

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place in the block, later than ``after``, with an excess of
        at most ``target``; -1 for none."""
        out = np.full(len(block), -1, np.int64)
        for at in range(0, len(block), 1 << 14):
            part = slice(at, at + (1 << 14))
            ok = (self.rows[block[part]] <= target[part, None]) & (np.arange(SPAN) > after[part, None])
            out[part] = np.where(ok.any(axis=1), ok.argmax(axis=1), -1)
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first later place
        whose excess is one less than there."""
        target = self.excess[at] - 1
        block = at // SPAN
        place = self._in_block(block, at % SPAN, target)
        todo = np.flatnonzero(place < 0)
        # Up: past a subtree of blocks whose minimum is too high.
        x, goal = block[todo] + 1, target[todo]
        level = np.full(len(todo), -1)
        for depth, minima in enumerate(self.minima):
            for _ in range(2):
                here = (level < 0) & (x < len(minima)) & (minima[np.minimum(x, len(minima) - 1)] <= goal)
                level[here] = depth
                x = np.where((level < 0) & (x % 2 == 0), x + 1, x) if _ == 0 else x
            x = np.where(level < 0, (x + 1) // 2, x)
        # Down: to the leftmost block whose minimum is low enough.
        for depth in range(len(self.minima) - 1, 0, -1):
            down = level == depth
            left = self.minima[depth - 1][np.where(down, 2 * x, 0)] <= goal
            x = np.where(down, 2 * x + ~left, x)
            level = np.where(down, depth - 1, level)
        block = block.copy()
        block[todo] = x
        place[todo] = self._in_block(x, np.full(len(x), -1), goal)
        return block * SPAN + place


def range_minima(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The minimum of ``size`` (at least 1) values from each start."""
    power = np.frexp(size.astype(float))[1] - 1
    out = np.empty(len(start), values.dtype)
    level = values
    for p in range(int(power.max()) + 1):
        own = np.flatnonzero(power == p)
        out[own] = np.minimum(level[start[own]], level[start[own] + size[own] - (1 << p)])
        level = np.minimum(level[:-(1 << p)], level[1 << p:]) if len(level) > 1 << p else level
    return out


# --- one block ---------------------------------------------------------------

LISTS = ("at", "convs", "kids", "leaves", "saved", "least")
#: What a block gives: nodes, weighted paths (spines), ids that end at a spine
#: node (ends) and the spine nodes that its complete nodes hang off (pair).
OUT = pa.schema([
    ("kind", pa.string()), ("block", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("ids", pa.string()), ("path", pa.binary()), ("first", pa.int64()), ("sizes", pa.list_(pa.int64())),
    *[(f"w_{x}", pa.list_(pa.int64())) for x in LISTS],
])
_SQL = {pa.string(): "string", pa.binary(): "binary", pa.int64(): "long", pa.list_(pa.int64()): "array<long>"}
OUT_SQL = ", ".join(f"{f.name} {_SQL[f.type]}" for f in OUT)
NOTHING = hashlib.sha256(b"").hexdigest()


def _rows(n: int, **given) -> pa.RecordBatch:
    """A batch of ``OUT`` with nulls where nothing is given."""
    made = {x: v if isinstance(v, pa.Array) else pa.array(v, OUT.field(x).type) for x, v in given.items()}
    return pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(n, f.type) for f in OUT], schema=OUT)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, values) of a column of lists."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of consecutive runs."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class Block:
    """The trie of sorted paths."""

    def __init__(self, rows: pa.Table, weighted: bool):
        rows = rows.combine_chunks()
        column = {c: rows[c].chunk(0) if rows[c].num_chunks else pa.array([], rows.schema.field(c).type) for c in rows.column_names}
        self.paths = column["path"].to_pylist()
        depth, self.turn_sizes = _flat(column["sizes"])
        self.depth, rows_n = depth, len(depth)
        self.turn_at = np.cumsum(depth) - depth
        token = np.frombuffer(b"".join(self.paths), np.uint64).reshape(-1, TOKEN // 8)
        # Turns that a path shares with the one before it.
        common = np.minimum(depth[1:], depth[:-1])
        i = np.repeat(np.arange(1, rows_n), common)
        place = _places(common)
        same = (token[self.turn_at[i] + place] == token[self.turn_at[i - 1] + place]).all(axis=1)
        shared = np.concatenate([[0], common])
        np.minimum.at(shared, i[~same], place[~same])
        self.shared = shared
        # Nodes in preorder; 0 is the root.
        opened = depth - shared
        self.last = np.cumsum(opened)  # a row's last own node, or an earlier row's if it opens none
        n = int(opened.sum()) + 1
        row = np.repeat(np.arange(rows_n), opened)
        self.node_depth = np.concatenate([[0], shared[row] + _places(opened) + 1])
        self.node_row = np.concatenate([[0], row])
        self.n = n
        order = np.lexsort((np.arange(n), self.node_depth))
        self.by_depth = self.node_depth[order] * (n + 1) + order
        self.size = np.zeros(n, np.int64)
        self.size[1:] = self.turn_sizes[self.turn_at[row] + self.node_depth[1:] - 1]
        # A row closes what it doesn't share, then opens its own.
        counts = np.zeros(2 * rows_n, np.int64)
        counts[0::2] = opened
        counts[1::2] = np.concatenate([depth[:-1] - shared[1:], depth[-1:]])
        counts[0] += 1
        counts[-1] += 1
        self.brackets = Parentheses(np.repeat(np.tile(np.array([1, 0], np.int8), rows_n), counts))
        close = self.brackets.findclose(self.brackets.opens)
        self.below = (close - self.brackets.opens + 1) // 2  # nodes in a subtree
        rank = self.brackets.leaf_rank
        self.leaf_pairs = rank[close] - rank[self.brackets.opens]
        first = self.node_depth[1:] == shared[row] + 1
        up = np.arange(n) - 1
        up[1:][first] = self.node_of(self.node_depth[1:][first] - 1, np.flatnonzero(first))
        self.parent = up
        self._payload(column, weighted)

    def node_of(self, depth: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """The latest node of that depth, up to node number ``upto``."""
        at = np.searchsorted(self.by_depth, depth * (self.n + 1) + upto, side="right") - 1
        return self.by_depth[at] % (self.n + 1)

    def _payload(self, column: dict, weighted: bool) -> None:
        if weighted:
            lengths, at = _flat(column["w_at"])
            row = np.repeat(np.arange(len(lengths)), lengths)
            values = {x: _flat(column[f"w_{x}"])[1] for x in LISTS[1:]}
        else:
            row, at = np.arange(len(self.depth)), self.depth
            self.ids = column["conv_id"].to_numpy(zero_copy_only=False)
            values = {"convs": np.ones(len(row), np.int64), "least": self.ids}
        node = self.node_of(at, self.last[row])
        self.end_node = None if weighted else node
        self.own = {x: np.zeros(self.n, np.int64) for x in LISTS[1:]}
        self.own["least"][:] = np.iinfo(np.int64).max
        for x, v in values.items():
            (np.minimum if x == "least" else np.add).at(self.own[x], node, v)

    def spine(self, row: int) -> np.ndarray:
        """The nodes of a row's path, the root first."""
        return self.node_of(np.arange(self.depth[row] + 1), np.int64(self.last[row]))

    def totals(self, complete: np.ndarray) -> dict[str, np.ndarray]:
        """What each subtree holds; of nodes that aren't complete, only what
        hangs off the spines counts as saved."""
        start = np.arange(self.n)
        end = start + self.below

        def total(values: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(values)])
            return running[end] - running[start]

        own = self.own
        kids = np.bincount(self.parent[1:], minlength=self.n)
        convs = total(own["convs"])
        # A pair () stands for no leaf where children were left in other blocks.
        hidden = (kids == 0) & (own["kids"] > 0)
        return {
            "convs": convs, "kids": kids + own["kids"],
            "leaves": self.leaf_pairs + total(own["leaves"] - hidden),
            "saved": total(np.where(complete, (convs - 1) * self.size, 0) + own["saved"]),
            "least": range_minima(own["least"], start, self.below),
        }


def _keys(path: bytes) -> list[bytes]:
    """A name for each prefix of a path, from the empty one."""
    running = hashlib.sha256()
    out = [running.digest()[:TOKEN]]
    for at in range(0, len(path), TOKEN):
        running.update(path[at:at + TOKEN])
        out.append(running.copy().digest()[:TOKEN])
    return out


def encode(rows: pa.Table, name: str, weighted: bool, final: bool) -> Iterator[pa.RecordBatch]:
    """One block: its complete nodes, and what other blocks need."""
    trie = Block(rows, weighted)
    left = trie.spine(0)
    right = trie.spine(len(trie.depth) - 1)
    right = right[~np.isin(right, left)]
    complete = np.ones(trie.n, bool)
    keys: dict[int, bytes] = {}
    for nodes, row in ((left, 0), (right, -1)):
        named = _keys(trie.paths[row])
        keys.update({int(k): named[trie.node_depth[k]] for k in nodes})
        if not final:
            complete[nodes] = False
    whole = trie.totals(complete)
    # The names of complete nodes that were spines of earlier blocks.
    own_key = [None] * trie.n
    if weighted:
        for i in range(len(trie.paths)):
            if trie.last[i] > (trie.last[i - 1] if i else -1) or i == 0:
                named = _keys(trie.paths[i])
                for k in range(int(trie.last[i - 1]) + 1 if i else 0, int(trie.last[i]) + 1):
                    own_key[k] = named[trie.node_depth[k]]
    nodes = np.flatnonzero(complete)
    up = trie.parent[nodes]
    inside = (up >= 0) & complete[up]
    hanging = (up >= 0) & ~complete[up]
    parent_conv = np.where(inside, whole["least"][up], 0)
    digests = {}
    if not weighted:
        cut = np.flatnonzero(np.diff(trie.end_node)) + 1
        for ids, k in zip(np.split(trie.ids, cut), trie.end_node[np.concatenate([[0], cut])]):
            text = ",".join(map(str, ids.tolist()))
            if complete[k]:
                digests[int(k)] = hashlib.sha256(text.encode()).hexdigest()
            else:
                yield _rows(1, kind=["ends"], block=[name], key=[keys[int(k)]], first=[int(ids[0])], ids=[text])
    if len(nodes):
        yield _rows(
            len(nodes), kind=["node"] * len(nodes), block=[name] * len(nodes), key=[own_key[k] for k in nodes],
            parent_key=[keys[int(u)] if h else None for u, h in zip(up, hanging)],
            conv_id=whole["least"][nodes], depth=trie.node_depth[nodes],
            parent_conv_id=pa.array(parent_conv, mask=~inside), n_convs=whole["convs"][nodes],
            n_children=whole["kids"][nodes], n_leaves=whole["leaves"][nodes], saved_tokens=whole["saved"][nodes],
            ends_sha256=[None if weighted else digests.get(int(k), NOTHING) for k in nodes],
        )
    if final:
        return
    off = sorted({keys[int(u)] for u in up[hanging]})
    if off:
        yield _rows(len(off), kind=["pair"] * len(off), block=[name] * len(off), key=off)
    # What hangs off each spine node: its own and its complete children.
    hung = {x: v.copy() for x, v in trie.own.items()}
    child = nodes[hanging]
    for x in LISTS[1:]:
        (np.minimum if x == "least" else np.add).at(hung[x], trie.parent[child], 1 if x == "kids" else whole[x][child])
    for spine, row in ((left, 0), (right, len(trie.depth) - 1)):
        if len(spine):
            sizes = trie.turn_sizes[trie.turn_at[row]:trie.turn_at[row] + trie.depth[row]]
            yield _rows(
                1, kind=["path"], block=[name], path=[trie.paths[row]], first=[int(hung["least"][spine].min())], sizes=[sizes],
                w_at=[trie.node_depth[spine]], **{f"w_{x}": [hung[x][spine]] for x in LISTS[1:]},
            )


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Sorted rows in blocks of bounded size."""
    held, rows, turns = [], 0, 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, most - rows)
            at += part.num_rows
            held.append(part)
            rows += part.num_rows
            turns += len(part.column("sizes").flatten())
            if rows >= most or (turns >= TURNS and rows >= 4):
                yield pa.Table.from_batches(held)
                held, rows, turns = [], 0, 0
    if held and rows:
        yield pa.Table.from_batches(held)


# --- the whole ---------------------------------------------------------------

def rebuilt(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    group: int = 5, heads: int = 9,
) -> DataFrame:
    """(conv_id, path, sizes): the first h turns of the first conversation of
    each ``group``, h = crc32 of the id modulo ``heads``, then a conversation's
    own turns after its first h."""
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = rows.filter(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv_id"),
        F.struct(
            col(turn_col).isNotNull().alias("told"), F.coalesce(col(turn_col).cast("long"), F.lit(0)).alias("turn"),
            F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("t"),
    ).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.array_sort(F.collect_list("t")).alias("own"))
    # At most 2 * group - 1 conversations have one base.
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, heads - 1))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.withColumns({"head": head, "h": h}).withColumn(
        "seq",
        F.concat(
            F.when(F.col("head").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h"))),
            F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))),
        ),
    )
    digests: Column = F.array_join(F.transform("seq", lambda t: F.substring(t["digest"], 1, 2 * TOKEN)), "")
    return both.select("conv_id", F.unhex(digests).alias("path"), F.transform("seq", lambda t: t["size"]).alias("sizes"))


def _encoded(paths: DataFrame, level: int, weighted: bool, final: bool, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches, 1 << 40 if final else most)):
            yield from encode(block, f"{level}-{part}-{number}", weighted, final)

    return written(paths.mapInArrow(run, OUT_SQL), f"trie-{level}")


def _digest_ends(ends: DataFrame) -> DataFrame:
    """(key, sha): the texts of ids of each spine node, in order, through one
    running digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if own != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pydict({"key": [key], "sha": [running.hexdigest()]})
                    key, running = own, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
        if key is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "sha": [running.hexdigest()]})

    dealt = ends.select("key", "first", "ids").repartition("key").sortWithinPartitions("key", "first")
    return dealt.select("key", "ids").mapInArrow(run, "key binary, sha string")


def trie(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    group: int = 5, heads: int = 9, block_rows: int = ROWS, weighted_rows: int = WEIGHTED,
) -> DataFrame:
    """One row per distinct prefix: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    weighted_rows = max(weighted_rows, 8)  # a block of fewer paths might leave as many as it had
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = rebuilt(rows, conv_col, turn_col, role_col, text_col, group, heads)
    dealt = paths.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    levels = [_encoded(dealt, 0, False, False, block_rows)]
    names = ["path", "first", "sizes", *[f"w_{x}" for x in LISTS]]
    while True:
        spines = levels[-1].filter("kind = 'path'").select(*names)
        n = spines.count()
        if not n:
            break
        final = n <= weighted_rows
        dealt = spines.coalesce(1) if final else spines.repartitionByRange(-(-n // weighted_rows), "path", "first")
        levels.append(_encoded(dealt.sortWithinPartitions("path", "first"), len(levels), True, final, weighted_rows))
        if final:
            break
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    nodes = every.filter("kind = 'node'")
    ends = _digest_ends(levels[0].filter("kind = 'ends'"))
    # Nodes that were spines: named, few, with the ids that end there.
    named = nodes.filter("key IS NOT NULL").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(NOTHING))).drop("sha")
    done = nodes.filter("key IS NULL").unionByName(named)
    # A node that hangs off a spine learns its parent by block and name.
    parents = every.filter("kind = 'pair'").select("block", "key").join(
        nodes.filter("key IS NOT NULL").select("key", F.col("conv_id").alias("above")), "key"
    ).withColumnRenamed("key", "parent_key")
    off = done.filter("parent_key IS NOT NULL").join(parents, ["block", "parent_key"]).withColumn("parent_conv_id", F.col("above")).drop("above")
    out = done.filter("parent_key IS NULL").unionByName(off)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
