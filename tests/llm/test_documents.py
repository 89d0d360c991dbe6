"""Operators on documents against brute force, and on odd input."""

import collections
import hashlib
import math
import random
import re
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, exact_dedup, langid, licenses, packing, parts, pii, secret_scan, simhash

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def both(docs, odd_docs):
    return docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))


# --- 1: language -------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) > 0


def test_language_odd_input(odd_docs, no_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (2, 3, 4, 5))
    assert by[9].lang_pred == "de" and by[6].lang_pred == "en" and 0 <= by[6].score <= 1
    assert langid.identify(no_docs).collect() == []
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_language_backoff_scores_longest_known_gram():
    model = langid.Model(
        ["x", "y"], {"known": 0}, np.log([[0.9, 0.1]]), {"^a": 0, "b": 1, "b$": 2, "$": 3, "a": 4},
        np.log([[0.5, 0.1], [0.2, 0.3], [0.4, 0.2], [0.5, 0.5], [0.1, 0.1]]), np.array([-9.0, -9.0]),
    )
    got = langid._Scorer(model).unseen(["ab"])[0]
    back = langid.BACKOFF
    want = [(math.log(a) + 2 * back + math.log(b) + 3 * back + math.log(c) + 2 * back) / 3 for a, b, c in ((0.5, 0.2, 0.4), (0.1, 0.3, 0.2))]
    assert np.allclose(got, want)


def brute_language(model, text):
    """Word by word and position by position, in plain Python."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not any(c.isalpha() for w in words for c in w):
        return "und", 0.0
    sums = [0.0] * len(model.langs)
    for w in words:
        if w in model.words:
            own = model.word_logs[model.words[w]]
        else:
            padded, parts = f"^{w}$", []
            for at in range(1, len(padded)):
                for lost, k in enumerate(langid.ORDERS):
                    if k - 1 <= at and padded[at - k + 1:at + 1] in model.grams:
                        parts.append(model.gram_logs[model.grams[padded[at - k + 1:at + 1]]] + lost * langid.BACKOFF)
                        break
                else:
                    parts.append(model.floor)
            own = sum(parts) / len(parts)
        sums = [a + b for a, b in zip(sums, own)]
    best = max(range(len(sums)), key=lambda i: (sums[i], -i))
    return model.langs[best], 1 / sum(math.exp(x - sums[best]) for x in sums)


def test_language_against_brute_force(spark, docs, odd_docs):
    model = langid.fit(docs)
    rows = both(docs, odd_docs)
    want = collections.Counter((r.doc_id, *(lambda p: (p[0], round(p[1], 6)))(brute_language(model, r.text))) for r in rows.collect())
    got = langid.identify(rows.withColumn("lang", F.lit("en")), model=model).collect()
    assert collections.Counter((r.doc_id, r.lang_pred, round(r.score, 6)) for r in got) == want


def test_language_model_by_brute_force(docs):
    """Counts behind the model: every word and n-gram of the training rows."""
    model = langid.fit(docs)
    train = [r for r in docs.collect() if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    words = collections.Counter((r.lang, w) for r in train for w in regex.findall(r"\p{L}+", r.text.lower()))
    assert set(model.words) == {w for _, w in words} and model.langs == sorted({r.lang for r in train})
    total = {x: sum(n for (lang, _), n in words.items() if lang == x) for x in model.langs}
    for w, i in list(model.words.items())[::50]:
        for k, lang in enumerate(model.langs):
            assert math.isclose(model.word_logs[i][k], math.log((words[lang, w] + 0.5) / (total[lang] + 0.5 * len(model.words))))
    assert set(model.grams) == {f"^{w}$"[a:a + k] for _, w in words for k in langid.ORDERS for a in range(len(w) + 3 - k)}


# --- 8: exact dedup ----------------------------------------------------------

def brute_groups(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id is None, r.doc_id))
    out = []
    for norm, members in groups.items():
        first = min(members)[2]
        kept = False
        for _, _, i in sorted(members, key=str):
            out.append((i, first, len(members), i == first and not kept, hashlib.sha256(norm.encode()).hexdigest()))
            kept |= i == first
    return out


def test_exact_groups(docs, odd_docs):
    both_docs = both(docs.where("doc_id > 20"), odd_docs)
    want = brute_groups(both_docs.collect())
    got = [tuple(r) for r in exact_dedup.groups(both_docs).collect()]
    assert collections.Counter(got) == collections.Counter(want)


def test_exact_identifiers_are_verified(odd_docs):
    """A weak first identifier is found out, and the next seed is used."""
    def weak(chunk, seed):
        return [F.lit(0).cast("long"), F.lit(0).cast("long")] if seed == 0 else exact_dedup.chunk_id(chunk, seed)

    assert exact_dedup.verified_seed(odd_docs, "text", weak) == 1
    assert collections.Counter(map(tuple, exact_dedup.groups(odd_docs, identify=weak).collect())) == collections.Counter(
        map(tuple, exact_dedup.groups(odd_docs).collect())
    )


def test_exact_keeps_one_row_each_with_all_columns(odd_docs, no_docs):
    kept = exact_dedup.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter([4, 5, 7, 8, 9, 10, 11])
    assert exact_dedup.groups(no_docs).collect() == [] and exact_dedup.deduplicate(no_docs).collect() == []


def test_chunks_are_content_defined(spark):
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40_000))
    rows = spark.createDataFrame([(text,), ("zz" + text,)], "text string").select(exact_dedup.chunks("text").alias("c")).collect()
    a, b = (r.c for r in rows)
    assert "".join(a) == text and "".join(b) == "zz" + text and max(map(len, a)) <= exact_dedup.LONGEST
    assert len(set(a) & set(b)) >= 0.8 * len(a)  # an insertion moves few cuts


# --- 3: SimHash --------------------------------------------------------------

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(fps, bits):
    """Smallest label of each fingerprint's component, by all pairs."""
    fps, parent = list(fps), {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("leaf", [4096, 2])
def test_simhash_components(docs, odd_docs, leaf):
    rows = both(docs.where("doc_id > 20"), odd_docs)
    texts = rows.collect()
    fp = [brute_fingerprint(r.text) for r in texts]
    root = components_of(set(fp), 2)
    least = {}
    for r, f in zip(texts, fp):
        if r.doc_id is not None:
            least[root[f]] = min(least.get(root[f], r.doc_id), r.doc_id)
    want = collections.Counter((r.doc_id, f"{f:016x}", least.get(root[f])) for r, f in zip(texts, fp))
    assert collections.Counter(map(tuple, simhash.near_duplicates(rows, leaf=leaf).collect())) == want


@pytest.mark.parametrize("leaf", [4096, 8])
def test_trie_join_finds_every_component(spark, leaf):
    """Chains and dense balls of near fingerprints, and random ones."""
    rnd = random.Random(7)
    fps = {rnd.getrandbits(64) for _ in range(150)}
    for _ in range(6):
        x = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(x)
            x ^= 1 << rnd.randrange(64)
            x ^= 1 << rnd.randrange(64)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, leaf)
    label = {}
    for r in simhash.components(found).collect():
        label[r.node % (1 << 64)] = r.label
    want = components_of(fps, 2)
    groups = collections.defaultdict(set)
    for f in fps:
        groups[want[f]].add(f)
    assert all(len({label.get(f, f) for f in g}) == 1 for g in groups.values())
    assert len({label.get(f, f if f < 1 << 63 else f - (1 << 64)) for f in fps}) == len(groups)


def test_simhash_odd_input(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {2}
    kept = simhash.deduplicate(odd_docs)
    assert kept.dtypes == odd_docs.dtypes and len(kept.collect()) == len({r.component_id for r in rows})
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.deduplicate(no_docs).collect() == []


# --- 4: secrets --------------------------------------------------------------

def brute_secrets(text):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_secret_base_spans(docs, odd_docs):
    rows = both(docs, odd_docs)
    texts = collections.Counter()
    for r in rows.collect():
        spans = brute_secrets(r.text or "")
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        texts[(r.doc_id, *[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(joined.encode()).hexdigest())] += 1
    got = secret_scan.scan(rows).collect()
    assert collections.Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == texts
    assert sum(texts[x] for x in texts if x[1]) > 0
    for odd in ("tokEn=secret=abcdefghijkl", "secret: password: abcdefghijklmn", "ſecret=abcdefghijklmnop", "AKIA" + "Q" * 13, "api_key='" + "Z" * 12 + "'"):
        assert secret_scan.base_spans(odd) == brute_secrets(odd)


def test_randomness_battery_and_discovery_control():
    rnd = random.Random(2)
    alphabet = secret_scan.ENCODINGS[9]
    random_runs = ["".join(rnd.choice(alphabet) for _ in range(40)) for _ in range(300)]
    assert sum(map(secret_scan.battery, random_runs)) >= 0.95 * 300
    for run in ("a" * 40, "ab" * 20, "0123456789" * 4, "".join(sorted(random_runs[0]))):
        assert not secret_scan.battery(run)
    # no discoveries among few weak values, some among strong ones
    assert secret_scan.threshold({1: 5}, 1000, 0.01) == math.inf
    assert secret_scan.threshold({200: 3, 1: 5}, 1000, 0.01) == 200 * secret_scan.BIN


def test_secret_redaction(spark, odd_docs, no_docs):
    rnd = random.Random(3)
    keys = ["".join(rnd.choice(secret_scan.ENCODINGS[9]) for _ in range(44)) for _ in range(20)]
    plain = "ordinary words make up this text and nothing in it is secret at all "
    docs = spark.createDataFrame([(i, plain * 20 + k, 7) for i, k in enumerate(keys)] + [(99, plain, 7)], "doc_id long, text string, n_chars int")
    rows = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert sum("[SECRET]" in rows[i].text for i in range(20)) >= 17
    assert rows[99].text == plain and rows[99].n_chars == 7
    hit = next(r for r in rows.values() if "[SECRET]" in r.text)
    assert hit.n_chars == len(hit.text)
    out = secret_scan.redact(odd_docs)
    assert out.dtypes == odd_docs.dtypes and out.count() == odd_docs.count()
    masked = next(r.text for r in out.collect() if r.doc_id == 10)
    assert "abcdef0123456789" not in masked and "AKIA" not in masked and "bob@example.com" in masked
    assert secret_scan.redact(no_docs).collect() == [] and secret_scan.scan(no_docs).collect() == []


# --- 5: personal data --------------------------------------------------------

def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_pii_base_spans(spark, odd_docs, no_docs):
    rows = both(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), odd_docs)
    want = collections.Counter()
    for r in rows.collect():
        spans = brute_pii(r.text or "")
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        want[(r.doc_id, *[sum(s[0] == k for s in spans) for k in range(4)], hashlib.sha256(joined.encode()).hexdigest())] += 1
    got = pii.find(rows).collect()
    assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    assert pii.find(no_docs).collect() == []
    for odd in ("a@b@c.de", "x.@y.z..w @ a@b a@b.c@d.e", "..@a-.b", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4", "+1 22", "4-1-1 1"):
        assert pii.base_spans(odd) == brute_pii(odd)


def test_pii_skip_links_carry_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(docs)
    text = "Call +1 (988) 555-2485 today. Later on call 988-555-2485 again. Version 4.0 of 2024 has 12 parts."
    g = pii.graph(text, pii.base_spans(text))
    found = [(k, text[a:b]) for k, a, b in pii.added_spans(text, g, model.marginals([g])[0])]
    assert found == [(3, "988-555-2485")]
    g.skip = []  # without the links it stays unknown or unsure
    alone = model.marginals([g])[0]
    linked = model.marginals([pii.graph(text, pii.base_spans(text))])[0]
    at = next(i for i, (a, b) in enumerate(g.spans) if text[a:b] == "988-555-2485")
    assert linked[at][4] > alone[at][4]


FORMS = ("988 555 2485", "988.555.2485", "988-555-2485", "(988) 555 2485", "9885552485")


def test_pii_number_in_other_forms(spark):
    """One recognised form, five others; none is found where none is known."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(docs)

    def added(text):
        g = pii.graph(text, pii.base_spans(text))
        return [(pii.KINDS[k], re.sub("[^0-9]", "", text[a:b])) for k, a, b in pii.added_spans(text, g, model.marginals([g])[0])]

    between = " and these words stand in between here, then "
    for forms in (FORMS, FORMS[::-1]):
        text = "Call +1 (988) 555-2485 today." + between + between.join(forms) + " is all. Chapter 12 has 345 pages of 2024."
        assert added(text) == [("phone", "9885552485")] * 5
    assert added(between.join(("988 555 2485", "version 4.0 of 2024", "12 345"))) == []
    # Planted: a known number and one other form of it, beside other numbers.
    rnd = random.Random(11)
    right = wrong = planted = 0
    for _ in range(200):
        area, a, b = rnd.randint(200, 999), rnd.randint(200, 999), rnd.randint(1000, 9999)
        form = rnd.choice(("{} {} {}", "{}.{}.{}", "{}-{}-{}", "({}) {} {}", "{}{}{}")).format(area, a, b)
        noise = f"In {rnd.randint(1900, 2030)} there were {rnd.randint(1, 999)} {rnd.randint(100, 999)} of {rnd.randint(10**6, 10**8)} items"
        found = added(f"{noise}. Phone +1-{area}-{a}-{b}. {between} {form} ok. {noise}.")
        planted += 1
        right += ("phone", f"{area}{a}{b}") in found
        wrong += sum(x != ("phone", f"{area}{a}{b}") for x in found)
    assert right >= 0.97 * planted and wrong <= 0.03 * planted, (right, wrong)


def test_pii_no_card_against_the_checksum(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(docs)
    for text in ("Number 2123465659789240 is here.", "see 9870157079875996", "4000 1234 5678 9010 x"):
        assert not luhn(re.sub("[^0-9]", "", text)) and pii.base_spans(text) == []
        g = pii.graph(text, [])
        assert pii.added_spans(text, g, model.marginals([g])[0]) == []
    rows = pii.find(docs, model=model).select("doc_id", "n_added", "spans").where("n_added > 0").join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in rows:
        for kind, a, b in (x.split(":") for x in r.spans.split(",")):
            if kind == "card":
                assert luhn(re.sub("[^0-9]", "", r.text[int(a):int(b)]))


def test_pii_labels_reach_all_occurrences(spark):
    model = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    between = " Some words stand here in between and end. "
    for known, bare, kind in (("+1 (988) 555-2485", "988-555-2485", 3), ("+1-988-555-2485", "9885552485", 3)):
        for place in (0, 50, 100):  # where the recognised one stands
            text = between.join([*[bare] * place, f"call {known} today", *[bare] * (100 - place)])
            g = pii.graph(text, pii.base_spans(text))
            found = pii.added_spans(text, g, model.marginals([g])[0])
            assert len(found) == 100 and all(k == kind and text[a:b] == bare for k, a, b in found), (known, bare, place)
            assert len(g.skip) + len(g.far) <= 6 * len(g.spans)
    # A document's marginals don't depend on those read with it.
    other = pii.graph("Version 4.0 of 2024 has 12 parts.", [])
    assert np.allclose(model.marginals([g])[0], model.marginals([other, g])[1])


def test_pii_linear_on_long_runs():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "+1" + "(" * 100_000, "1.1" * 60_000, "@" * 50_000):
        pii.graph(text, pii.base_spans(text))


# --- 6: packing --------------------------------------------------------------

def test_packing(docs, odd_docs):
    added = docs.limit(9).withColumn("text", F.concat("text", F.lit(" <|endoftext|> and<|endoftext|><|endoftext|>\n"), "text"))
    rows = both(docs, odd_docs).unionByName(added.select("doc_id", "text"))
    tokenizer = Tokenizer.from_file(JSON)
    want = collections.Counter()
    for r in rows.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        at, n = 0, len(ids) % 1024 or 1024
        for piece in range(-(-len(ids) // 1024)):
            want[(r.doc_id, piece, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()))] += 1
            at, n = at + n, 1024
    got = packing.pack(rows, JSON, PATTERN).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.05 * math.ceil(sum(r.length for r in got) / 1024) + 1


def test_packing_with_ids(docs, odd_docs):
    rows = both(docs, odd_docs)
    got = packing.pack(rows, JSON, PATTERN, with_ids=True).collect()
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    light = packing.pack(rows, JSON, PATTERN).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == collections.Counter(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in light
    )
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_packing_empty(no_docs):
    assert packing.pack(no_docs, JSON, PATTERN).collect() == []


def test_packing_plan_uses_every_piece_once():
    rnd = np.random.default_rng(4)
    for lengths in (rnd.integers(1, 1025, 5000), np.full(100, 513), np.full(77, 1), rnd.integers(300, 400, 3000)):
        histogram = dict(zip(*map(list, np.unique(lengths, return_counts=True))))
        planned = packing.plan({int(k): int(v) for k, v in histogram.items()}, 1024)
        used = collections.Counter()
        for content, n in planned:
            assert sum(content) <= 1024 and n > 0
            for x in content:
                used[x] += n
        assert used == {int(k): int(v) for k, v in histogram.items()}


def test_non_negative_least_squares():
    patterns = np.array([[0, 1, 3], [0, 2, 2], [1, 1, 2]])
    x = packing.fit_repeats(patterns, np.array([0.0, 7.0, 8.0, 5.0]), rounds=2000)
    matrix = np.array([[1, 0, 2], [0, 2, 1], [1, 0, 0]], float)
    assert (x >= 0).all() and np.allclose(matrix @ x, [7, 8, 5], atol=0.2)


def test_ids_equal_the_tokenizers_own():
    tokenizer = Tokenizer.from_file(JSON)
    own = packing.Ids(JSON, PATTERN)
    texts = ["", " ", "a  b   c\n\n d\t e", "it's we'll  x", "\U0001f389 \u3000wide", "a\x1c b", "x" * 3000, "a <|endoftext|> b", "<|endoftext|>", "\n \n a \n",
             "<|endoftext|><|endoftext|>x", "<|endoftext", "\u00a0 a \u2003 b\u0085 c \u00e9 d", "\u4e2d \u6587 \u1680 x", " <|endoftext|> "]
    for block in (texts, [x for x in texts if "|>" not in x], texts[::-1]):
        flat, bounds = own.texts(pa.array(block, pa.string()))
        got = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == [tokenizer.encode(x, add_special_tokens=False).ids for x in block]
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]


def test_ids_of_the_ranked_vocabulary_are_the_tokenizers(spark):
    """On every text of the table, and on noise."""
    tokenizer = Tokenizer.from_file(JSON)
    own = packing.Ids(JSON, PATTERN)
    assert own.ranked is not None and packing.ranks_of(JSON) == {k: v for k, v in bpe.read_ranks(RANKS).items()}
    rnd = random.Random(12)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["".join(rnd.choice("abcdefgh \n.,'éß中1290-_/\\") for _ in range(400)) for _ in range(300)]
    texts += ["".join(chr(rnd.randint(1, 0xD7FF)) for _ in range(50)) for _ in range(300)]
    flat, bounds = own.texts(pa.array(texts, pa.string()))
    got = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    own.ranked = None  # by the tokenizer itself, parts laid end to end
    own.parts._clear()
    flat, bounds = own.texts(pa.array(texts[-400:], pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == got[-400:]


def test_parts_are_cut_before_words_only():
    """The parts of any text, tokenised alone, give the words of the whole."""
    pattern = regex.compile(PATTERN)
    rnd = random.Random(9)
    signs = ["a", "B", "1", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u2003", "\u0085", "\x1c", "\u00e9", "\u4e2d", "'s", ".", "\U0001f389", "\u1680", "\u200b", "\x7f"]
    for _ in range(2000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25)))
        raw = text.encode()
        at = [0, *parts.cuts(np.frombuffer(raw, np.uint8)).tolist(), len(raw)]
        cut = [raw[a:b].decode() for a, b in zip(at, at[1:])]
        assert [w for p in cut for w in pattern.findall(p)] == pattern.findall(text), ascii(text)


# --- 7: licences -------------------------------------------------------------

def test_licences(spark, no_docs):
    mit = dict(licenses.KNOWN)["MIT"]
    docs = spark.createDataFrame([
        (1, "Copyright (c) 2020 Some One\n\n" + mit.upper().replace(",", " ,")),
        (2, "Some text\nLICENCED under the Apache Licence version 2.0\nmore\nReleased under the MIT License."),
        (3, None), (3, None), (4, "..."), (None, "Licensed under CC BY-NC 4.0"),
    ], "doc_id long, text string")
    got = sorted(map(tuple, licenses.scan(docs).collect()), key=str)
    assert got == sorted([
        (1, "MIT", 0, "MIT"), (2, None, 2, "Apache-2.0,MIT"), (3, None, 0, ""), (3, None, 0, ""), (4, None, 0, ""),
        (None, "CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"),
    ], key=str)
    assert licenses.scan(no_docs).collect() == []


def test_licences_long_texts_and_clashing_columns(spark, odd_docs):
    line = "Released under the MIT License.\n"
    more = spark.createDataFrame([(50, "words and words\n" * 30_000 + line * 3), (51, "licence " * 40_000)], "doc_id long, text string")
    rows = odd_docs.unionByName(more, allowMissingColumns=True).withColumns({"licence": F.lit("x"), "digest": F.lit("x"), "n_lines": F.lit(1)})
    got = licenses.scan(rows)
    assert got.columns == ["doc_id", "licence", "n_lines", "licences"] and got.count() == rows.count()
    assert {(r.doc_id, r.n_lines, r.licences) for r in got.where("n_lines > 0").collect()} == {(50, 3, "MIT")}


def brute_canonical(text, one_line):
    """The canonical form, again, with Python's own regular expressions."""
    def java(pattern):
        return pattern.replace("(?m)", "")

    def sub(pattern, new, x):
        return regex.sub(java(pattern), new, x, flags=regex.M if "(?m)" in pattern else 0)

    x = text.lower()
    sign = any(s in x for s in ("copyright", "(c)", "©", "&copy;"))
    if not one_line:
        x = sub(licenses.LINE_END, "\n", x)
        if sign:
            x = sub(licenses.HELD, "\n\ncopyright ", x)
        x = regex.sub(r"(?<!\n)\n(?!\n)", " ", regex.sub(r"(?<=[a-z])-\n(?=[a-z])", "-", x))
    if sign:
        x = sub(licenses.NOTICE, " ", sub(licenses.HELD + licenses._NOTICE_END, " ", x))
    for found, same in licenses.SPELLINGS:
        x = regex.sub(found, same.replace("$1", r"\1"), x)
    return regex.sub(licenses.OTHERS, " ", x).strip(" ")


def test_licences_against_brute_force(spark, odd_docs):
    """Every text and every line is brought to form and looked up, also those
    that the operator leaves out beforehand."""
    known = {}
    for name, text in sorted(licenses.default_texts(), reverse=True):
        known[brute_canonical(text, False)] = name
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    texts = [(1000 + i, rewrapped(t, 70) if i % 2 else "some words\n" + " ".join(t.split())) for i, (_, t) in enumerate(licenses.default_texts())]
    docs = docs.unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    want = collections.Counter()
    for r in docs.collect():
        whole = known.get(brute_canonical(r.text or "", False) or None)
        lines = [x for x in (known.get(brute_canonical(line, True) or None) for line in (r.text or "").split("\n")) if x]
        want[(r.doc_id, whole, len(lines), ",".join(sorted({*lines, *([whole] if whole else [])})))] += 1
    assert collections.Counter(map(tuple, licenses.scan(docs).collect())) == want


def test_licence_signs_cover_every_known_form(spark):
    forms = licenses.known_forms(spark)
    signs = licenses.signs_of(forms)
    assert 0 < len(signs) <= 10 and len(forms) > 200
    for _, text in licenses.default_texts():
        assert any(s in text.lower() for s in signs)
    assert licenses.signs_of(["a b c", "software x"]) == []  # a form without such a word: all texts are looked at


def rewrapped(text, width, comment=""):
    paragraphs = [" ".join(x.split()) for x in text.split("\n\n")]
    return "\n\n".join(textwrap.fill(x, width, initial_indent=comment, subsequent_indent=comment) for x in paragraphs)


def test_licences_however_wrapped(spark):
    head = "Copyright (c) 2019-2024 J. R. Smith, Some Firm Inc. and others"
    docs = []
    for name, text in (("MIT", licenses._MIT), ("ISC", licenses._ISC)):
        for width in (40, 60, 70, 72, 76, 78, 79, 80, 100, 120):
            docs += [(name, rewrapped(text, width)), (name, f"{head}\n\n{rewrapped(text, width)}"), (name, f"{head}\n{rewrapped(text, width)}"),
                     (name, rewrapped(f"{head}. All rights reserved.\n\n{text}", width, " * ")), (name, rewrapped(text, width).replace("\n", "\r\n"))]
        whole = " ".join(text.split())
        docs += [(name, whole), (name, f"{head} {whole}"), (name, f"Copyright Some One\n{rewrapped(text, 72)}")]
    lines = [
        ("Copyright 2024 X. Licensed under the MIT License.", "MIT"), ("(c) 2024 Some One, Ltd. Released under the MIT License.", "MIT"),
        ("© Some One. Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Copyright Some One", None), ("Copyright holders are not liable.", None),
    ]
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(docs + [(None, x) for x, _ in lines])], "doc_id long, text string")
    got = {r.doc_id: r.licence for r in licenses.scan(rows).collect()}
    assert [got[i] for i in range(len(docs))] == [name for name, _ in docs]
    assert [got[len(docs) + i] for i in range(len(lines))] == [name for _, name in lines]


WHOLE = {
    "Apache-2.0": "http://www.apache.org/licenses/", "GPL-2.0": "Version 2, June 1991", "GPL-3.0": "Version 3, 29 June 2007",
    "LGPL-2.1": "Version 2.1, February 1999", "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE", "MPL-2.0": "Mozilla Public License Version 2.0",
    "CC0-1.0": "CC0 1.0 Universal", "CC-BY-SA-4.0": "Attribution-ShareAlike 4.0 International", "Unlicense": "free and unencumbered",
    "BSD-2-Clause": "Redistributions in binary form", "BSD-3-Clause": "Neither the name",
}


def test_whole_texts_of_common_licences(spark):
    docs = []
    for name, sign in WHOLE.items():
        text = next(t for n, t in licenses.default_texts() if n == name and sign in t and len(t) > 1000)
        wraps = [text, *[rewrapped(text, width) for width in (60, 72, 80, 100)], rewrapped(text, 76, "# ")]
        docs += [(name, x) for y in wraps for x in (y, f"Copyright (c) 2021, The Authors\n\n{y}")]
    lines = [
        ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Released under the BSD 3-Clause License.", "BSD-3-Clause"),
        ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"), ("This project is licensed under the Mozilla Public License, version 2.0.", "MPL-2.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ]
    notice = next(t for n, t in licenses.default_texts() if n == "Apache-2.0" and t.startswith('Licensed under the Apache License, Version 2.0 (the "License");\n'))
    lines += [("Copyright 2020 Some One\n\n" + rewrapped(notice, 66, "// "), "Apache-2.0")]
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(docs + [(n, x) for x, n in lines])], "doc_id long, text string")
    got = {r.doc_id: r.licence for r in licenses.scan(rows).collect()}
    want = [n for n, _ in docs] + [n for _, n in lines]
    assert [(i, got[i], w) for i, w in enumerate(want) if got[i] != w] == []


# --- 10: BPE -----------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library(docs, odd_docs, no_docs, library):
    rows = both(docs, odd_docs)
    want = collections.Counter()
    for r in rows.collect():
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[(r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, bpe.round_trip(rows, RANKS, PATTERN).collect())) == want
    assert bpe.round_trip(no_docs, RANKS, PATTERN).collect() == []


def test_bpe_odd_words(library):
    own = bpe.Encoder(RANKS, PATTERN)
    rnd = random.Random(5)
    for text in ("a" * 3000, "ab" * 700, "".join(rnd.choice("abcdefgh") for _ in range(1500)), "  x   y\n\n z", "日本語" * 120, "é" * 300, "1234567890" * 40, " " * 400 + "x"):
        ids = own.encode(pa.array([text]))[0]
        assert ids.tolist() == library.encode_ordinary(text) and own.decode([ids]) == [text.encode()]
        assert own.digest(ids) == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_bpe_unsafe_tokens_by_brute_force():
    own = bpe.Encoder(RANKS, PATTERN)
    merges = own.db.execute("SELECT l, r, id FROM merges").fetchall()
    least = {}
    for l, r, i in merges:
        for part in (l, r):
            least[part] = min(least.get(part, i), i)
    want = {i for _, _, i in merges if least.get(i, i) < i}
    assert {r[0] for r in own.db.execute("SELECT id FROM unsafe").fetchall()} == want


def test_bpe_digest_is_that_of_the_decoded_ids(monkeypatch, library):
    """A wrong id shows in the decoded bytes; blocks cut ids anywhere."""
    own = bpe.Encoder(RANKS, PATTERN)
    texts = ["the cat sat on the mat é日本", "", "x" * 500, "the dog sat"]
    ids = [np.array(library.encode_ordinary(t), np.int32) for t in texts]
    for size in (500_000, 7, 1):
        monkeypatch.setattr(bpe, "DECODED", size)
        assert own.decode(ids) == [t.encode() for t in texts]
        wrong = [x.copy() for x in ids]
        wrong[0][1] += 1
        assert own.decode(wrong)[0] != texts[0].encode() and own.decode(wrong)[1:] == own.decode(ids)[1:]


def test_bpe_decode(spark, docs, library):
    ids = bpe.round_trip(docs, RANKS, PATTERN, with_ids=True).select("doc_id", "ids")
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode(ids, RANKS, PATTERN).collect()}
    assert back == {r.doc_id: r.text or "" for r in docs.collect()}
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(empty, RANKS, PATTERN).collect()] == [b"", b""]
