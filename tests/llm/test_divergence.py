"""Operator 11 against brute force, its packed terms, and odd input."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import divergence


def brute(rows):
    """The contract, literally."""
    lower = {c: c + 32 for c in range(65, 91)}
    counts, docs, groups = collections.Counter(), collections.Counter(), set()
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r.text or "").translate(lower))
        counts.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    kept = collections.defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= 10:
            kept[lang].append(t)
    total = collections.Counter()
    for (lang, _, t), n in counts.items():
        total[lang, t] += n
    out = collections.Counter()
    for lang in {g[0] for g in groups}:
        terms, v = kept[lang], len(kept[lang])
        sources = [s for x, s in groups if x == lang]

        def shares(count):
            n = sum(map(count, terms))
            return {t: 1 + 1000000000 * (count(t) + 2) // (n + 2 * v) for t in terms}

        q = shares(lambda t: total[lang, t])
        p = {s: shares(lambda t: counts[lang, s, t]) for s in sources}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in terms), o.encode()) for o in sources if o != s]
            own = [(-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode()) for t in terms if counts[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:10])):
                out.update((lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1))
    return out


def got(df):
    return collections.Counter(map(tuple, divergence.audit(df).collect()))


def test_audit_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text", "lang", "source")
    assert got(df) == brute(df.collect())


def test_audit_odd_input(spark, odd_docs, no_docs):
    rnd = random.Random(6)
    words = ["a", "Zebra", "sixteen-letters", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "l" * 300, "ünï", "日本語の文", "é", "x1y"]
    rows = [(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))), rnd.choice(["en", "en", "", None]), rnd.choice([None, "", "s1", "s2", "ß"])) for _ in range(300)]
    rows += [("one source only " * 3, "xx", "s"), (None, "yy", "a"), ("", "yy", "b"), ("few", "yy", "c")]
    df = odd_docs.selectExpr("text", "lang", "source", "score", "`a.b`", "kept AS value", "label AS part").unionByName(
        spark.createDataFrame(rows, "text string, lang string, source string"), allowMissingColumns=True
    )
    want = brute(df.collect())
    assert got(df) == want and any(r[0] == "yy" and r[4] == 0 for r in want) and not any(r[0] == "xx" and r[2] == "pair" for r in want)
    assert got(no_docs) == {}


@pytest.mark.parametrize("tile", [7])
def test_audit_by_tiles_and_buckets(spark, monkeypatch, tile):
    """Many small tiles and buckets, so that a term is absent from some."""
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BUCKET", 300)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang", "source")
    assert got(df) == brute(df.collect())


def brute_counts(texts):
    n, docs = collections.Counter(), collections.Counter()
    for t in texts:
        found = re.findall(rb"[A-Za-z\x80-\xff]+", t.encode())
        found = [x.lower() if x.isascii() else bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in found]
        n.update(found)
        docs.update(set(found))
    return {t: (n[t], docs[t]) for t in n}


def tally(texts):
    own = divergence.Tally()
    half = len(texts) // 2
    for part in (texts[:half], texts[half:]):
        own.add(["en"] * len(part), ["s"] * len(part), pa.array(part, pa.string()))
    out = {}
    for batch in own.rows():
        for r in batch.to_pylist():
            word = b"".join((r[x] % (1 << 64)).to_bytes(8, "big") for x in "ab" if r[x] is not None).rstrip(b"\0")
            out[r["tail"] if r["tail"] is not None else word] = (r["n"], r["docs"])
    return out


def test_terms_are_packed_and_counted(monkeypatch):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("abAB é-") for _ in range(rnd.randint(0, 200))) for _ in range(200)]
    texts += ["", "no", "NO", "x" * 8, "x" * 9, "x" * 16, "x" * 17, "y" * 5000, "end", "startend", "日本 " * 50]
    assert tally(texts) == brute_counts(texts)
    monkeypatch.setattr(divergence, "BLOCK", 50)  # long texts in slices, a document counted once
    monkeypatch.setattr(divergence, "HELD", 20)
    assert tally(texts) == brute_counts(texts)


def test_radix_order_is_stable():
    rnd = np.random.default_rng(8)
    a, b = rnd.integers(0, 3, 5000).astype(np.uint32), rnd.integers(0, 1 << 63, 5000).astype(np.uint64) >> np.uint64(40)
    b[::7] |= np.uint64(1 << 63)
    order = divergence.radix_order([a, b])
    assert order.tolist() == sorted(range(5000), key=lambda i: (a[i], b[i], i))
