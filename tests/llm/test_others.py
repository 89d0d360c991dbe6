"""Vector search, page extraction, components, the pipeline and the entry."""

import collections
import html
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import components, html_extract, topk

SMALL = "/root/testdata/sf0.001"


def brute_top(rows, k=5):
    ok = [
        (r.vec_id, np.floor(256 * np.array(r.embedding, float)))
        for r in rows
        if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)
    ]
    width = max((len(v) for _, v in ok), default=0)
    ids, m = [i for i, _ in ok], np.array([np.pad(v, (0, width - len(v))) for _, v in ok]).reshape(len(ok), width)
    out = set()
    for q in {i for i in ids if i % 50 == 0}:
        score = m @ m[ids.index(q)]
        best = sorted((-s, i) for s, i in zip(score, ids) if i != q)[:k]
        out |= {(q, rank, i, int(-s)) for rank, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("options", [{}, {"pivots": 3, "rings": 2, "sample": 20}])
def test_top_k(spark, options):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert set(map(tuple, topk.top_k(rows, **options).collect())) == brute_top(rows.collect())


def test_top_k_odd_input(spark):
    rnd = random.Random(1)
    vectors = [(i, [rnd.gauss(0, 1) for _ in range(8)], "x") for i in range(1, 130)]
    vectors += [(50_000 + i, [0.5] * 8, "x") for i in range(400)]  # many ties
    vectors += [(0, [0.25] * 8, "x"), (1000, None, None), (1001, [None] * 8, "x"), (1050, [float("nan")] * 8, "x"),
                (1100, [float("inf")] + [0.0] * 7, "x"), (1150, [], "x"), (1200, [1.0, 2.0], "x"), (None, [1.0] * 8, "x")]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score string")
    assert set(map(tuple, topk.top_k(rows).collect())) == brute_top(rows.collect())
    assert topk.top_k(rows.limit(0)).collect() == []
    few = rows.where("vec_id IN (0, 3, 5)")
    assert set(map(tuple, topk.top_k(few).collect())) == brute_top(few.collect())


def test_rings_that_cannot_hold_a_neighbour_are_not_visited():
    """The bound is a true lower bound of the distance."""
    rnd = np.random.default_rng(3)
    data = np.floor(256 * rnd.normal(size=(500, 6)))
    longest = float((data**2).sum(axis=1).max())
    index = topk.Index(data[:100], 6, longest, 8, 4)
    pivot, ring, distance = index.place(data)
    lifted = index.lift(data)
    for q in data[:20]:
        asked = index.lift(q[None], asked=True)
        reach = index.distances(asked)[0]
        true = np.sqrt(((lifted - asked) ** 2).sum(axis=1))
        assert (np.abs(reach[pivot] - distance) <= true + 1e-6).all()
        assert np.allclose(true**2, longest + (q**2).sum() - 2 * data @ q)


def test_components_against_brute_force(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1080)]
    edges += [(2000, x) for x in range(2001, 2100)] + [(5, 5), edges[0]]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


# --- pages -------------------------------------------------------------------

def article(page):
    """The text that these synthetic pages mark by their elements."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", b))).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(rows) == pages.count() and all(r.text == article(r.html) and r.n_chars == len(r.text) for r in rows)


@pytest.fixture(scope="module")
def potentials(spark):
    return html_extract.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_layouts_not_trained_on(potentials):
    """Precision and recall of blocks; the plainest layouts exactly."""
    from layouts import LAYOUTS

    right = found = wanted = 0
    for name, html, want in LAYOUTS:
        got = collections.Counter(x for x in html_extract.main_text(html, potentials).split("\n\n") if x)
        want = collections.Counter(want)
        if name in ("bare body", "bare body, same line twice", "topbar and post-content", "disqus", "alert inside", "role complementary"):
            assert got == want, name
        right, found, wanted = right + sum((got & want).values()), found + sum(got.values()), wanted + sum(want.values())
    assert len(LAYOUTS) >= 30 and right >= 0.97 * found and right >= 0.97 * wanted, (right / found, right / wanted)


def test_pages_long_and_with_clashing_columns(spark):
    line = "Some words that make a sentence of the story here."
    long = "<article><h1>Title</h1>" + f"<p>{line}</p>" * 20_000 + "</article>"
    pages = spark.createDataFrame([(1, "u", long, 9, "x", "y")], "page_id long, url string, html string, n_chars int, text string, `a.b` string")
    row = html_extract.extract(pages).first()
    assert row.text == "\n\n".join(["Title", *[line] * 20_000]) and row.n_chars == len(row.text)


def test_page_furniture(potentials):
    line = "Some words that make a sentence of the story here."
    page = (
        f'<html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><div id="sidebar"><p>{line}</p></div>'
        f'<article class="post"><h2>Title &amp; more</h2><p>{line} {line}</p><p>{line}&nbsp; x</article>'
        f'<div class="cookie-notice">{line}</div><form><p>{line}</p></form><footer>f</footer><script>var a = "<p>";</script></body></html>'
    )
    assert html_extract.main_text(page, potentials) == f"Title & more\n\n{line} {line}\n\n{line} x"
    for odd in (None, "", "<", "<article", "</p></div>", "<nav>menu</nav>", "<!-- x -->"):
        assert html_extract.main_text(odd, potentials) == ""
    assert html_extract.main_text("<article><p>cut &amp", potentials) == "cut &"
    deep = "<div>" * 3000 + line + "</div>" * 3000
    assert isinstance(html_extract.main_text(deep, potentials), str)


@pytest.mark.parametrize("silent", [
    "<script>var x = '<p>';</script>", "<style>p{}</style>", "<svg><title>icon</title><path d='M0'/></svg>", "<button>press</button>",
    "<iframe src='x'></iframe>", "<noscript><div>without</div></noscript>", "<select><option>a<option>b</select>",
    "<button><p>press</p> <b>now</b></button>", "<svg/>", "<script>a</script><script>b</script><script>c</script>", "<BUTTON >press</BUTTON >",
])
def test_silent_elements_inside_a_block(potentials, silent):
    line = "Some words that make a sentence of the story here."
    page = f'<html><head><title>T</title><script>h</script></head><body><article><h1>Title</h1><p>Alpha words {silent} beta.</p><p>{line}</p></article><div>after it</div></body></html>'
    texts = list(html_extract.read(page).texts.values())
    if silent != "<svg/>":
        assert texts == ["Title", "Alpha words beta.", line, "after it"]
        assert html_extract.main_text(page, potentials) == f"Title\n\nAlpha words beta.\n\n{line}"
    plain = html_extract.read(page.replace(silent, ""))
    tree = html_extract.read(page)
    if silent != "<svg/>":
        assert (tree.parents, tree.features) == (plain.parents, plain.features)


def test_silent_elements_without_an_end(potentials):
    page = "<body><article><p>Alpha words <button>press</article><article><p>A second one.</p></article></body>"
    assert list(html_extract.read(page).texts.values()) == ["Alpha words", "A second one."]
    page = "<head><title>T</title><noscript><body><article><p>Words of the text.</p></article>"
    assert list(html_extract.read(page).texts.values()) == ["Words of the text."]


def test_marginals_are_exact(potentials):
    """Sum-product against the sum over all labellings of a small tree."""
    import itertools
    import math

    tree = html_extract.read("<body><nav><p>a</p></nav><article><p>some text here.</p></article></body>")
    n = len(tree.parents)
    unary = [sum(potentials.weights.get(f, 0.0) for f in fs) for fs in tree.features]
    total, one = 0.0, [0.0] * n
    for labels in itertools.product((0, 1), repeat=n):
        s = sum(u for u, x in zip(unary, labels) if x)
        for i in range(1, n):
            p = tree.parents[i]
            s += potentials.pair[tree.features[p][0] in html_extract.TOP][labels[p]][labels[i]]
        w = math.exp(s)
        total += w
        for i, x in enumerate(labels):
            one[i] += w * x
    assert np.allclose(potentials.marginals(tree), [x / total for x in one], atol=1e-9)


def test_pages_odd_input(spark):
    pages = spark.createDataFrame(
        [(1, "u", None, "x"), (1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>Words of the text.</p></article>", None)],
        "page_id long, url string, html string, text string",
    )
    rows = sorted(map(tuple, html_extract.extract(pages).collect()), key=str)
    assert rows == sorted([(1, "u", "", 0), (1, "u", "", 0), (2, None, "", 0), (None, "u", "Words of the text.", 18)], key=str)
    assert html_extract.extract(pages.limit(0)).collect() == []


# --- pipeline and entry ------------------------------------------------------

def test_pipeline_stages_keep_their_columns(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        columns = docs.dtypes
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.dtypes == columns, name
        assert "sequence_id" in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).columns


def test_pipeline_against_brute_force(spark):
    """Documents that stay after the two deduplications, by their texts."""
    from test_documents import brute_fingerprint, components_of

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    told = corpus_pipeline.language_id(spark, docs, SMALL)
    best = {}
    for r in told.collect():
        norm = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[norm] = min(best.get(norm, (1, 0, 0)), (-len(r.text or ""), r.doc_id, r.text))
    fp = {i: brute_fingerprint(t) for _, i, t in best.values()}
    root = components_of(set(fp.values()), 2)
    first = collections.defaultdict(lambda: 1 << 60)
    for i, f in fp.items():
        first[root[f]] = min(first[root[f]], i)
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(first.values())


def test_pipeline_returns_the_token_sequences(spark, odd_docs, no_docs):
    out = corpus_pipeline.STAGES[-1][1](spark, odd_docs, SMALL).collect()
    assert out and all(len(r.ids) == r.length for r in out)
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key in (1, 3, 7):
        ids = [x for r in sorted(out, key=lambda r: r.piece) if r.doc_id == key for x in r.ids]
        assert ids == tokenizer.encode(texts[key], add_special_tokens=False).ids + [2]
    assert "ids" in corpus_pipeline.STAGES[-1][1](spark, no_docs, SMALL).columns


def test_entry_registers_the_queries():
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names}
    assert set(entry.oracle_sql()) <= set(names)


def test_pipeline_leaves_only_its_result(spark):
    from tidemark.llm import common

    before = list(common._written)
    out = corpus_pipeline.run(spark, SMALL)
    new = [p for p in common._written if p not in before]
    assert len(new) == 1 and out.count() > 0
    common.release(spark, common._written.index(new[0]))
    assert common._written == before
