"""Operator 12 against brute force, its parentheses, and odd input."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import prefix_trie


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """The contract, literally, over Python tuples."""
    own = collections.defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            own[r.conv_id].append((r.turn is not None, r.turn or 0, sha(f"{len(role)}:{role}{text}"), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        seqs[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return collections.Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
         sha(",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p))))))
        for p, m in members.items()
    )


def got(df, **options):
    return collections.Counter(map(tuple, prefix_trie.trie(df, **options).collect()))


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 7, "weighted_rows": 5}])
def test_trie_of_the_table(spark, blocks):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(df, **blocks) == brute(df.collect())


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 5, "weighted_rows": 4}, {"block_rows": 1, "weighted_rows": 9}])
def test_trie_of_random_and_equal_conversations(spark, blocks):
    """Few different turns, so that prefixes are shared and many are copies."""
    rnd = random.Random(3)
    rows = []
    for c in range(300):
        if c % 3 == 0:  # a third are copies of one
            rows += [(c, t, "user", f"same {t}") for t in range(10)]
        else:
            rows += [(c, t, "user", rnd.choice("ab")) for t in range(rnd.randint(1, 14))]
    df = conversations(spark, rows).repartition(5)
    assert got(df, **blocks) == brute(df.collect())


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 2, "weighted_rows": 3}])
def test_trie_odd_input(spark, blocks):
    rows = [
        (None, 0, "user", "x"), (0, None, "user", None), (0, 1, None, "b"), (0, 1, None, "b"), (0, 1, "user", "é"), (1, 0, "user", "own"),
        (2, 5, "user", ""), (3, 0, "", "user"), (4, 0, "user", "y" * 100_000), (-3, 0, "user", "x"), (-3, 1, "user", "y"), (-7, 0, "u", "z"),
        (9, 0, "user", "turnless when its head is longer"), (14, 0, "user", "q"), (14, 1, "user", "q"),
        *[(c, t, "user", f"long {t}") for c in (50, 51, 55) for t in range(60)],
    ]
    df = conversations(spark, rows)
    clash = df.selectExpr("*", "1 AS path", "2 AS depth", "3 AS size", "4 AS `a.b`", "5 AS base", "6 AS own")
    want = brute(df.collect())
    assert got(clash, **blocks) == want and any(r[1] == 0 and r[3] == len({x[0] for x in rows} - {None}) for r in want)
    assert got(conversations(spark, [])) == {}


def test_trie_of_a_long_conversation(spark):
    df = spark.range(40_000).selectExpr("id % 2 * 5 AS conv_id", "id div 2 AS turn", "'user' AS role", "concat('turn ', id div 2) AS text")
    rows = {r.depth: r for r in prefix_trie.trie(df).collect()}
    assert len(rows) == 20_001 and all((r.n_convs, r.n_leaves, r.conv_id) == (2, 1, 0) for r in rows.values())
    sizes = [len(f"turn {t}") for t in range(20_000)]
    assert rows[0].saved_tokens == sum(sizes) and rows[20_000].saved_tokens == sizes[-1] and rows[20_000].n_children == 0
    assert rows[20_000].ends_sha256 == sha("0,5") and rows[7].ends_sha256 == sha("")


def test_parentheses_against_a_stack():
    rnd = random.Random(4)
    shapes = [[1, 0], [1] * 500 + [0] * 500, [1, *[1, 0] * 700, 0]]
    for _ in range(20):
        bits, high = [1], 1
        while len(bits) < rnd.choice((50, 3000)):
            up = high == 1 or rnd.random() < 0.5
            bits.append(int(up))
            high += 1 if up else -1
        shapes.append(bits + [0] * high)
    for bits in shapes:
        stack, want = [], {}
        for at, b in enumerate(bits):
            if b:
                stack.append(at)
            else:
                want[stack.pop()] = at
        p = prefix_trie.Parentheses(np.array(bits, np.int8))
        close = p.findclose(p.opens)
        assert dict(zip(p.opens.tolist(), close.tolist())) == want
        pairs = [sum(bits[x] and not bits[x + 1] for x in range(a, b)) for a, b in want.items()]
        assert [int(p.leaf_rank[b] - p.leaf_rank[a]) for a, b in want.items()] == pairs


def test_range_minima():
    rnd = np.random.default_rng(5)
    values = rnd.integers(0, 1000, 777)
    start = rnd.integers(0, 777, 500)
    size = rnd.integers(1, 778 - start)
    assert prefix_trie.range_minima(values, start, size).tolist() == [values[a:a + n].min() for a, n in zip(start, size)]
