"""Operator 9: main text of web pages by a tree-structured graphical model.

A page becomes a tree: its block elements, and a leaf for each block of text.
Elements whose text is never shown are no part of it; the text around one that
stands inside a block is one leaf.
Every node has a hidden label, content or not.  Unary potentials come from the
element's tag, the words of its class, id and role (and known words inside
them, so that an unseen name may say something), and from what its subtree
holds: share of the page's text, share of link text, sentences, its place
before or after its largest sibling; for a leaf, from its length, share of
link text, end and element.  Pairwise potentials tie a child's label to its
parent's.  Sum-product
messages, once upward and once downward, give each leaf's exact marginal, and
leaves that are more likely content than not are the page's text.

The potentials are smoothed counts from labelled pages: a bounded hash sample
of the table's own pages (``max_train_pages``), labelled where they say so
themselves (``article``, ``main``), together with the labelled examples below,
which show the kinds of furniture that a page may have, named by known words,
by words that say nothing, or not at all.  Other labelled pages
may be given; there, ``data-main`` marks content.

Defined results: a null or empty page, or one without content, gives an empty
text; markup is read leniently (unclosed and misnested elements, a page that
is cut off); scripts, styles, titles and comments of the markup are never
text; white space in a block, no-break spaces included, becomes one space;
repeated rows are extracted alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, small_batches, text_or_empty

BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 header footer nav aside form fieldset ul ol li dl dt dd "
    "table caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary dialog hr menu "
    "center legend optgroup search hgroup".split()
)
#: Elements whose text is never page text.
SILENT = frozenset("head title script style noscript template svg math iframe object canvas select textarea button audio video".split())
SILENT_END = re.compile(rf"(?i)</({'|'.join(sorted(SILENT))})(?=[\s/>])")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An opening tag that ends these open ones.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "body": {"head"},
}
#: Elements that an implied end does not look beyond.
FENCES = frozenset("ul ol dl table menu article section div body html".split())
WORDS = re.compile(r"[a-z]+")
MARK = "data-main"
#: Added to a feature's share among the nodes of a label, and the largest
#: weight.  A leaf's looks say less than its element's names.
SMOOTH = {"word": 0.00000001, "kind=element": 0.000004, "kind=leaf": 0.2}
LARGEST = {"word": 12.0, "kind=element": 7.0, "kind=leaf": 7.0}
#: What a subtree holds is told by several features that go together; a known
#: word inside another says less than the word itself.
STRUCTURE, PART_OF_WORD = 0.5, 0.7
#: Features of elements; the others are leaves'.
SUBTREE = ("mass=", "dense=", "sentences=", "side=")
ELEMENT = ("tag=", "word=", "has=", *SUBTREE)
#: Elements of which it says little whether they come before or after a larger one.
SMALL = frozenset("tag=" + t for t in "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre figure figcaption".split())
#: Weight of the labelled examples, against one for the table's own pages.
SHOWN = 3.0
#: Elements whose children are sections of the page, each on its own.
TOP = ("tag=root", "tag=html", "tag=body")
#: Words of class and id that training examples use (fixed values).
FURNITURE = (
    "ad ads adsense advert advertisement alert author avatar backtotop banner bio bookmarks bottombar breadcrumb breadcrumbs byline "
    "captcha carousel cart categories comment comments complementary consent contentinfo cookie cookies copyright cta dialog "
    "disclaimer discussion disqus donate dropdown email feedback feed follow footer form forum gdpr header legal links login logo "
    "masthead menu meta metadata modal more nav navbar navigation newsletter notice notification offcanvas optin outbrain pager "
    "pagination paywall popular popup print privacy promo promoted promotion rating recommend recommended register related replies "
    "reply respond responses review reviews rss search share sharing shop sidebar signup skip skyscraper social sponsor sponsored "
    "subscribe subscription suggestions survey taboola tagcloud tags teaser thread toast toolbar tools topbar trending tweet utility "
    "warning widget widgets"
).split()
MAIN = "article body content entry hentry main page post prose single story text".split()
#: Words that say nothing, for examples.
SILENT_WORDS = "block box col column container grid group inner item layout region row unit wrap wrapper zone".split()
#: Known words that are looked for inside longer ones.
INNER = frozenset(w for w in FURNITURE if len(w) >= 3) - {"more", "form", "bio", "ads", "cta", "rss", "meta", "tools", "feed", "links", "email", "print"}
#: Least length of a sentence block.
SENTENCE = 40


def _words(names: str) -> list[str]:
    """Words of class, id and role, and the known ones inside unknown ones."""
    out = set()
    for w in WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", names).lower()):
        out.add(f"word={w}")
        if w not in KNOWN and len(w) > 3:
            out.update(f"has={x}" for x in INNER if x in w)
    return sorted(out)


KNOWN = frozenset(FURNITURE) | frozenset(MAIN) | frozenset(SILENT_WORDS)


class Tree(HTMLParser):
    """Nodes in page order: (parent, features, marked); texts of the leaves."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parents: list[int] = []
        self.features: list[list[str]] = []
        self.marked: list[bool] = []
        self.texts: dict[int, str] = {}
        self.link_text: dict[int, float] = {}
        self.stack: list[tuple[str, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = False
        self.silent = 0
        #: End tags of silent elements that are still to come.
        self.ending: Counter = Counter()
        self.add(-1, ["tag=root"], False)

    def add(self, parent: int, features: list[str], marked: bool) -> int:
        self.parents.append(parent)
        self.features.append(features)
        self.marked.append(marked or (parent >= 0 and self.marked[parent]))
        return len(self.parents) - 1

    def place(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            share = self.linked / max(1, sum(map(len, self.parts)))
            size = min(9, int(math.log2(len(text))))
            ends = "stop" if text[-1] in ".!?:;\"'”»" else "open"
            tag = self.stack[-1][0] if self.stack else "root"
            at = self.add(self.place(), [f"size={size}", f"links={min(4, int(share * 4.999))}", f"end={ends}", f"in={tag}"], False)
            self.texts[at] = text
            self.link_text[at] = share * len(text)
        self.parts, self.linked = [], 0

    def close_to(self, depth: int) -> None:
        within = self.silent - sum(tag in SILENT for tag, _ in self.stack[depth:])
        if not within and self.stack[depth][0] not in SILENT:  # the text around a silent element goes on after it
            self.flush()
        self.silent = within
        del self.stack[depth:]

    def implied(self, tag: str) -> None:
        ends = ENDS.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name in ends:
                self.close_to(depth)
                if name == "p" or tag not in ENDS:
                    continue
                return
            if name in FENCES or name in SILENT and self.ending[name] > 0 and tag != "body":
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag == "a":
            self.in_link = True
        if tag in VOID and tag != "hr" or tag not in BLOCKS and tag not in SILENT:
            return
        self.implied(tag)
        if self.silent > 0 or tag in SILENT:
            # Without text, so without a node: what is pending stays its block's.
            if tag != "hr":
                self.stack.append((tag, self.place()))
                self.silent += tag in SILENT
            return
        if tag in BLOCKS:
            self.flush()
        if tag == "hr":
            return
        given = dict(attrs)
        names = f"{given.get('class') or ''} {given.get('id') or ''} {given.get('role') or ''}"
        at = self.add(self.place(), [f"tag={tag}", *_words(names)], MARK in given)
        self.stack.append((tag, at))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in SILENT:
            self.ending[tag] -= 1
        if tag in BLOCKS or tag in SILENT:
            depth = next((d for d in range(len(self.stack) - 1, -1, -1) if self.stack[d][0] == tag), None)
            if depth is not None:
                self.close_to(depth)

    def handle_data(self, data: str) -> None:
        if self.silent <= 0:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data)


    def describe(self) -> None:
        """What each element's subtree holds, as features."""
        n = len(self.parents)
        plain, linked, sentences = [0.0] * n, [0.0] * n, [0] * n
        largest = [-1] * n  # an element's child with the most unlinked text
        for i in range(n - 1, -1, -1):
            if i in self.texts:
                linked[i] = self.link_text[i]
                plain[i] = len(self.texts[i]) - linked[i]
                sentences[i] = plain[i] >= SENTENCE and self.features[i][2] == "end=stop"
            p = self.parents[i]
            if p >= 0:
                plain[p] += plain[i]
                linked[p] += linked[i]
                sentences[p] += sentences[i]
                if largest[p] < 0 or plain[i] >= plain[largest[p]]:
                    largest[p] = i
        for i in range(1, n):
            if i in self.texts or not plain[i] + linked[i]:
                continue
            share = plain[i] / (plain[0] or 1.0)
            links = linked[i] / (plain[i] + linked[i])
            big = largest[self.parents[i]]
            if big == i or plain[big] * 2 < plain[self.parents[i]] or big in self.texts:
                side = "own"
            else:
                side = "before" if i < big else "after"
            self.features[i] += [
                f"mass={sum(share > x for x in (0.02, 0.1, 0.3, 0.6))}", f"dense={sum(links > x for x in (0.1, 0.3, 0.6))}",
                f"sentences={min(3, sentences[i])}",
            ]
            if self.features[i][0] not in SMALL:
                self.features[i].append(f"side={side}")


def read(html: str) -> Tree:
    tree = Tree()
    tree.ending.update(map(str.lower, SILENT_END.findall(html)))
    tree.feed(html)
    tree.close()
    tree.flush()
    tree.describe()
    return tree


def _own_labels(tree: Tree) -> list[bool] | None:
    """Labels that a page gives by its own elements; None if it gives none."""
    content, sure = [False] * len(tree.parents), False
    for i, features in enumerate(tree.features):
        parent = tree.parents[i]
        inside = parent >= 0 and content[parent]
        if features[0] in ("tag=article", "tag=main"):
            content[i] = sure = True
        elif inside:
            furniture = features[0] in ("tag=nav", "tag=aside", "tag=footer", "tag=header", "tag=form")
            content[i] = not furniture and not any(f[5:] in FURNITURE for f in features if f.startswith("word="))
    return content if sure else None


def counted(tree: Tree, labels: list[bool]) -> Counter:
    """(feature or parent's label, own label) -> times."""
    counts: Counter = Counter()
    for i, features in enumerate(tree.features):
        label = int(labels[i])
        kind = "leaf" if i in tree.texts else "element"
        counts[f"kind={kind}", label] += 1
        for f in features:
            counts[f, label] += 1
        if tree.parents[i] >= 0:
            top = tree.features[tree.parents[i]][0] in TOP
            counts[f"parent={'top' if top else 'inner'}{int(labels[tree.parents[i]])}", label] += 1
    return counts


def examples() -> list[str]:
    """Labelled pages: each kind of furniture beside marked content, in pages
    of several builds, under known names, names that say nothing, and none."""
    line = "A paragraph of the article says a few things at some length, and then it ends."
    short = "It was so."
    item = '<li><a href="/x">Item</a></li>'
    remark = "<div><b>Ann</b><p>I agree with that!</p><a href='#'>Reply</a></div>"
    inners = (
        f"<p>{line}</p>" * 3, f"<h3>Head</h3><p>{line}</p><ul>{item * 4}</ul>", f"Short text here <p>{line * 2}</p>", f"{line} <p>We ask you.</p>",
        "<a href='/'>Home</a> <a href='/a'>About</a> <a href='/b'>Contact</a>", f"<h3>3 answers</h3>{remark * 3}", "<p>Please subscribe now.</p>",
    )
    pages = []
    for i, (word, inner) in enumerate((w, x) for w in FURNITURE for x in inners):
        named = word if i % 5 else (SILENT_WORDS[i % len(SILENT_WORDS)] if i % 2 and inner is not inners[0] else word)
        main = MAIN[i % len(MAIN)] if i % 3 else ("", SILENT_WORDS[i // 3 % len(SILENT_WORDS)])[i // 3 % 2]
        inside = i % 2 == 0 and named == word
        kind = ("div", "section", "div", "aside", "ul")[i % 5]
        extra = f'<{kind} class="{named}">{inner}</{kind}>' + f"<footer><p>{line}</p></footer>" * (i % 3 == 0)
        title = ("<h1>A title</h1>", "<header><h1>A title</h1></header>")[i % 2]
        parts = (f"<p>{line}</p><p>{short}</p>", f"<h2>Part</h2><p>{line}</p>", f"<h3>Small</h3><p>{line * 3}</p>", f"<blockquote>{line}</blockquote>", f"<ul><li>{line}</li></ul>")
        article = title + "".join(parts[: 2 + i % 4]) + f"<p>{line * (1 + i % 3)}</p>"
        # Marked blocks, so that furniture inside an article stays unmarked.
        article = re.sub(r"<(header|h1|h2|h3|p|blockquote|ul)>", rf"<\1 {MARK}>", article)
        tag = ("article", "main", "div", "section", "div")[i // 4 % 5]
        menu = (f"<nav><ul>{item * 5}</ul></nav>", f'<div class="{SILENT_WORDS[i % len(SILENT_WORDS)]}"><ul>{item * 5}</ul></div>')[i // 7 % 2]
        around = (f"<aside><h3>More</h3><p>{line}</p><p>{line}</p></aside><form><p>{line}</p></form>", "")[i // 3 % 2]
        whole = f'<{tag} class="{main}">{article}{extra * inside}</{tag}>'
        if i % 6 == 5 and not inside:  # no element around the text
            whole = article
        elif i % 6 == 4 and not inside:  # one inside another
            whole = f'<div class="{SILENT_WORDS[i % len(SILENT_WORDS)]}">{whole}</div>'
        pages.append(
            f"<body><header><p>Site name</p></header>{menu}{whole}{extra * (not inside)}{around}<footer><p>{line}</p></footer></body>"
        )
    return pages


def _marked(tree: Tree) -> list[bool]:
    """Labels by mark; an element that holds mostly marked text is content."""
    n = len(tree.parents)
    good, all_ = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if i in tree.texts:
            all_[i] += len(tree.texts[i])
            good[i] += len(tree.texts[i]) * tree.marked[i]
        if tree.parents[i] >= 0:
            good[tree.parents[i]] += good[i]
            all_[tree.parents[i]] += all_[i]
    return [tree.marked[i] or tree.features[i][0] not in TOP and good[i] * 2 > all_[i] for i in range(n)]


@dataclass
class Potentials:
    weights: dict[str, float]
    #: Log-probability of a child's label, by kind of parent and its label.
    pair: dict[bool, tuple[tuple[float, float], tuple[float, float]]]

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of each node, by messages up and down the tree."""
        n, parents = len(tree.parents), tree.parents
        get = self.weights.get
        one = [sum([get(f, 0.0) for f in fs]) for fs in tree.features]  # belief, as a log-ratio to "not content"
        up = [0.0] * n
        pairs = [self.pair[fs[0] in TOP] for fs in tree.features]
        for i in range(n - 1, 0, -1):
            p0, p1 = pairs[parents[i]]
            up[i] = _log_sum(p1[0], p1[1] + one[i]) - _log_sum(p0[0], p0[1] + one[i])
            one[parents[i]] += up[i]
        for i in range(1, n):
            p0, p1 = pairs[parents[i]]
            rest = one[parents[i]] - up[i]  # the parent's belief without this child
            one[i] += _log_sum(p0[1], p1[1] + rest) - _log_sum(p0[0], p1[0] + rest)
        out = one
        return [1 / (1 + math.exp(-x)) if x > -700 else 0.0 for x in out]


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def fit(
    pages: DataFrame,
    html_col: str = "html",
    labelled: list[str] | None = None,
    max_train_pages: int = 2_000,
) -> Potentials:
    """Smoothed log-ratios of the features and log-probabilities of a child's
    label given its parent's."""
    small_batches(pages.sparkSession)
    total = pages.count()
    span = 1 << 20
    chosen = pages.select(text_or_empty(html_col).alias("html")).filter(
        F.pmod(F.xxhash64("html"), F.lit(span)) < math.ceil(min(1.0, max_train_pages / max(1, total)) * span)
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for html in batch["html"]:
                tree = read(html)
                labels = _own_labels(tree)
                if labels:
                    counts += counted(tree, labels)
        yield pd.DataFrame([(f, label, n) for (f, label), n in counts.items()], columns=["feature", "label", "n"])

    rows = (
        chosen.mapInPandas(count, "feature string, label int, n long").groupBy("feature", "label").agg(F.sum("n").alias("n")).collect()
    )
    return learned(Counter({(r[0], r[1]): r[2] for r in rows}), labelled)


def learned(seen: Counter, labelled: list[str] | None = None) -> Potentials:
    """Potentials from the counts of a table's own pages and from labelled
    examples."""
    own = max(1, sum(n for (f, _), n in seen.items() if f.startswith("kind=")))
    shown: Counter = Counter()
    for html in examples() if labelled is None else labelled:
        tree = read(html)
        shown += counted(tree, _marked(tree))
    # So weighted that a table of one layout doesn't drown what they show.
    by = SHOWN * max(1.0, own / max(1, sum(n for (f, _), n in shown.items() if f.startswith("kind="))))
    for key, n in shown.items():
        seen[key] += n * by
    names = {f for f, _ in seen if not f.startswith(("parent=", "kind="))}
    weights = {}
    for f in names:
        # Of tags and words, how often in an element; of the rest, in a leaf.
        kind = "kind=element" if f.startswith(ELEMENT) else "kind=leaf"
        how = "word" if f.startswith("word=") else kind
        share = [seen[f, label] / max(1, seen[kind, label]) + SMOOTH[how] for label in (0, 1)]
        weight = max(-LARGEST[how], min(LARGEST[how], math.log(share[1] / share[0])))
        weights[f] = weight * STRUCTURE if f.startswith(SUBTREE) else weight
    for w in INNER:
        weights[f"has={w}"] = PART_OF_WORD * min(0.0, weights.get(f"word={w}", 0.0))
    pair = {}
    for top, name in ((True, "top"), (False, "inner")):
        of = [[seen[f"parent={name}{p}", c] / by + 0.5 for c in (0, 1)] for p in (0, 1)]
        pair[top] = tuple(tuple(math.log(x / sum(row)) for x in row) for row in of)
    return Potentials(weights, pair)


def main_text(html: str | None, potentials: Potentials) -> str:
    if not html:
        return ""
    tree = read(html)
    content = potentials.marginals(tree)
    return "\n\n".join([text for i, text in tree.texts.items() if content[i] > 0.5])


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    potentials: Potentials | None = None,
    **fit_options,
) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    small_batches(pages.sparkSession)
    potentials = potentials or fit(pages, html_col, **fit_options)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([main_text(h, potentials) for h in htmls], dtype=object)

    found = pages.select(col(id_col), col(url_col), run(text_or_empty(html_col)).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
