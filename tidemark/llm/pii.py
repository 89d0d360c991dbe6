"""Operator 5: personal data by fixed patterns and a skip-chain random field.

Base spans come from four patterns with their checks.  The field adds spans
that the patterns miss.  Its nodes are the tokens that hold a digit or an
at-sign (other words are never personal data of these kinds), labelled
``none`` or a kind.  Unary potentials score a token's shape; chain potentials
tie neighbouring tokens; skip potentials tie tokens far apart in a document
that repeat or resemble each other (the same text, the same last digits, the
same mailbox).  Tokens inside base spans are observed.  Loopy sum-product
messages carry labels along these links, so a number that once stands in a
recognised form is found again in another one, however often and however far
away: where no linked occurrence is observed as a kind, the key's first one so
observed is linked directly.  A document's messages are passed until none
moves (``ROUNDS`` only ends those whose loops have no fixed point).  A token whose marginal favours
a kind becomes a span, joined with its neighbours of that kind.

Potentials are smoothed counts over a bounded hash sample of the documents
(``max_train_docs``) labelled by the base patterns; skip potentials are
counted on consecutive occurrences.  Links join these and, for each kind, an
occurrence with one observed, so their number is linear in a document's tokens.

Defined results: a null text counts as empty; no match gives zero counts and
the digest of an empty string; repeated rows are read alike; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, small_batches, text_or_empty

#: Base patterns and kinds, in the contract's order (fixed values).
KINDS = ("email", "ip", "card", "phone")
MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+")
HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LABELS = len(KINDS) + 1  # 0: none
SIGN = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
EDGE = ".,;:!?()[]{}\"'<>«»“”"
NOT_DIGIT = re.compile(r"[^0-9]")
ROUNDS, CLOSE = 1000, 1e-4
#: Fewest and most digits of a number that is recognised in another form.
SAME, MOST = 7, 19
#: Tokens whose messages are passed together; a document with more has them alone.
TOGETHER = 100_000
#: What is counted where the sample has nothing, for links of any kind and of
#: equal numbers, of which hardly any two are equal by chance.
SMOOTH = {"chain": 0.5, "skip": 0.5, "same": 1e-6}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each at-sign outwards: the mailbox is the
    run of its characters before the sign, as far as the last match's end."""
    done = 0
    at = text.find("@")
    while at >= 0:
        host = HOST.match(text, at + 1)
        if host:
            start = at
            while start > done and MAILBOX.match(text[start - 1]):
                start -= 1
            if start < at:
                yield start, host.end()
                done = host.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = [(0, *span) for span in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def tokens(text: str) -> list[tuple[int, int, int]]:
    """(start, end, where the word before it ends) of the words with a digit
    or an at-sign, without the signs at their edges."""
    out, reach = [], 0
    for m in SIGN.finditer(text):
        if m.start() < reach:
            continue
        start = m.start()
        while start > reach and not text[start - 1].isspace():
            start -= 1
        gap = SPACE.search(text, m.end())
        reach = gap.start() if gap else len(text)
        a, b = start, reach
        while a < b and text[a] in EDGE:
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        if a < b:
            out.append((a, b, start))
    return out


def shape(core: str) -> list[str]:
    digits = sum("0" <= c <= "9" for c in core)
    letters = sum(map(str.isalpha, core))
    size = next(i for i, most in enumerate((0, 1, 3, 4, 6, 7, 9, 12, 15, 19, 1 << 60)) if digits <= most)
    others = "".join(sorted({c for c in core if c in "@+-_%/="}))
    checked = []
    if 13 <= digits <= 19 and not letters:
        checked = [f"luhn={luhn(NOT_DIGIT.sub('', core))}"]
    return checked + [
        f"digits={size}", f"letters={min(letters, 3) if letters < 4 else 4 + (letters > 12)}",
        f"dots={min(core.count('.'), 4)}", f"others={others}", f"first={'d' if core[0].isdigit() else 'l' if core[0].isalpha() else core[0]}",
    ]


def keys(core: str) -> list[str]:
    """What a token is recognised by elsewhere in the document."""
    out = [f"t{core.lower()}"] if len(core) >= 4 else []
    digits = NOT_DIGIT.sub("", core)
    if len(digits) >= 7 and "@" not in core:
        out.append(f"d{digits[-7:]}")
    box = core.split("@")[0].lower()
    if len(box) >= 4 and not box.isdigit():
        out.append(f"m{box}")
    return out


def numbers(cores: list[str], joined: list[bool]) -> list[list[str]]:
    """Per token the numbers that it is written in together with neighbours:
    the digits of each window of adjacent digit tokens (``joined``: a token
    follows the one before it with nothing but separators between)."""
    out: list[list[str]] = [[] for _ in cores]
    digits = [NOT_DIGIT.sub("", c) if not any(map(str.isalpha, c)) and "@" not in c else "" for c in cores]
    for end in range(len(cores)):
        number, start = digits[end], end
        while number and joined[start] and digits[start - 1]:
            start -= 1
            number = digits[start] + number
            if len(number) > MOST:
                break
            if len(number) >= SAME:
                for i in range(start, end + 1):
                    out[i].append(f"n{number}")
    return out


@dataclass
class Graph:
    """Tokens of one document, their observed labels and their links."""

    spans: list[tuple[int, int]]
    shapes: list[list[str]]
    observed: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    #: Skip links from a key's first observed occurrence.
    far: list[tuple[int, int]]
    #: Those of ``skip`` and ``far`` whose tokens share a number.
    same: set[tuple[int, int]]


def graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    found = tokens(text)
    observed = [0] * len(found)
    starts = [t[0] for t in found]
    for kind, a, b in reversed(base):
        i = max(0, int(np.searchsorted(starts, a, "right")) - 1)
        while i < len(found) and found[i][0] < b:
            if found[i][1] > a:
                observed[i] = kind + 1
            i += 1
    joined = [False] * len(found)
    for i in range(1, len(found)):
        joined[i] = not text[found[i - 1][1]:found[i][0]].strip(EDGE + " \t\n")
    chain = [(i - 1, i) for i in range(1, len(found)) if joined[i]]
    cores = [text[a:b] for a, b, _ in found]
    known = [keys(core) + own for core, own in zip(cores, numbers(cores, joined))]
    for i, core in enumerate(cores):
        # A number alone in its token may also end a longer one elsewhere.
        digits = NOT_DIGIT.sub("", core)
        if SAME <= len(digits) <= MOST and "@" not in core and not any(map(str.isalpha, core)):
            known[i].append(f"n{digits}")
    for kind, a, b in base:
        if KINDS[kind] in ("card", "phone"):
            digits = NOT_DIGIT.sub("", text[a:b])
            i = int(np.searchsorted(starts, b, "left")) - 1  # the span's last token
            if i >= 0 and observed[i] == kind + 1:
                known[i] += [f"n{digits[-k:]}" for k in range(SAME, len(digits) + 1)]
    last: dict[str, int] = {}
    skip, same = set(), set()
    seen: dict[str, dict[int, int]] = {}  # key -> kind -> the first token observed as it
    for i, own in enumerate(known):
        for key in dict.fromkeys(own):
            if key in last and last[key] != i:
                skip.add((last[key], i))
                if key[0] in "dn":
                    same.add((last[key], i))
            last[key] = i
            if observed[i]:
                seen.setdefault(key, {}).setdefault(observed[i], i)
    near: dict[int, set[int]] = {}
    for i, j in skip:
        near.setdefault(i, set()).add(observed[j])
        near.setdefault(j, set()).add(observed[i])
    far = []
    for i, own in enumerate(known):
        if not observed[i]:
            for kind, first, number in sorted((*x, key[0] in "dn") for key in own for x in seen.get(key, {}).items()):
                if kind not in near.setdefault(i, set()):
                    near[i].add(kind)
                    far.append((first, i))
                    if number:
                        same.add((first, i))
    return Graph([(a, b) for a, b, _ in found], [shape(c) for c in cores], observed, chain, sorted(skip), far, same)


@dataclass
class Field:
    """Log potentials."""

    unary: dict[str, np.ndarray]
    unseen: np.ndarray
    prior: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    same: np.ndarray

    def marginals(self, graphs: list[Graph]) -> list[np.ndarray]:
        """Label marginals of all tokens; the documents are one large graph
        whose parts aren't linked."""
        first = np.cumsum([0, *[len(g.spans) for g in graphs]])
        n = int(first[-1])
        if not n:
            return [np.zeros((0, LABELS)) for _ in graphs]
        local = np.stack([
            self.prior + sum(self.unary.get(f, self.unseen) for f in shapes) for g in graphs for shapes in g.shapes
        ])
        observed = np.concatenate([np.array(g.observed, np.int64) for g in graphs])
        known = np.flatnonzero(observed)
        local[known] = -50.0
        local[known, observed[known]] = 0.0
        edges = [
            (first[k] + a, first[k] + b, 2 if kind and (a, b) in g.same else kind, k)
            for k, g in enumerate(graphs) for kind, pairs in ((0, g.chain), (1, g.skip), (1, g.far)) for a, b in pairs
        ]
        belief = local
        if edges:
            a, b, kind, part = np.array(edges, np.int64).T
            tables = np.stack([self.chain, self.skip, self.same])
            source, target = np.concatenate([a, b]), np.concatenate([b, a])
            table = np.concatenate([tables[kind], tables[kind].transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            part = np.concatenate([part, part])
            message = np.zeros((len(source), LABELS))
            # What observed tokens say is there from the start; otherwise many
            # unsure ones could settle on another kind among themselves.
            sure = np.flatnonzero(observed[source])
            message[sure] = table[sure, observed[source[sure]]]
            message[sure] -= _log_sum(message[sure], 1)[:, None]
            live = np.arange(len(source))  # messages of the documents that still move
            for _ in range(ROUNDS):
                belief = local.copy()
                np.add.at(belief, target[live], message[live])
                sent = belief[source[live]] - message[back[live]]
                new = _log_sum(sent[:, :, None] + table[live], 1)
                new -= _log_sum(new, 1)[:, None]
                new = 0.5 * (new + message[live])  # damped, as there are loops
                moved = np.abs(new - message[live]).max(axis=1) >= CLOSE
                message[live] = new
                moving = np.zeros(len(graphs), bool)
                moving[part[live][moved]] = True
                live = live[moving[part[live]]]
                if not len(live):
                    break
            belief = local.copy()
            np.add.at(belief, target, message)
        share = np.exp(belief - _log_sum(belief, 1)[:, None])
        return [share[i:j] for i, j in zip(first[:-1], first[1:])]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _counts(text: str) -> Counter:
    g = graph(text, base_spans(text))
    out: Counter = Counter()
    for shapes, label in zip(g.shapes, g.observed):
        out["label", "", label] += 1
        for f in shapes:
            out["unary", f, label] += 1
    for name, pairs in (("chain", g.chain), ("skip", g.skip)):
        for i, j in pairs:
            out["same" if name == "skip" and (i, j) in g.same else name, str(g.observed[i]), g.observed[j]] += 1
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train_docs: int = 20_000) -> Field:
    """Potentials from a bounded sample; the base patterns label it."""
    small_batches(docs.sparkSession)
    total, span = docs.count(), 1 << 20
    rate = math.ceil(min(1.0, max_train_docs / max(1, total)) * span)
    chosen = docs.filter(F.pmod(F.xxhash64(F.lit("pii"), col(id_col).cast("string")), F.lit(span)) < rate)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                out += _counts(text)
        yield pd.DataFrame([(*key, n) for key, n in out.items()], columns=["kind", "name", "label", "n"])

    rows = (
        chosen.select(text_or_empty(text_col).alias("text")).mapInPandas(count, "kind string, name string, label int, n long")
        .groupBy("kind", "name", "label").agg(F.sum("n").alias("n")).collect()  # shapes: a fixed set
    )
    return field({(r[0], r[1], r[2]): r[3] for r in rows})


def field(seen: dict[tuple[str, str, int], int]) -> Field:
    labels = np.array([seen.get(("label", "", k), 0) for k in range(LABELS)], float)
    names = {name for kind, name, _ in seen if kind == "unary"}
    unary = {
        f: np.log((np.array([seen.get(("unary", f, k), 0) for k in range(LABELS)]) + 0.1) / (labels + 1)) for f in names
    }

    def ties(name: str) -> np.ndarray:
        """How much likelier two linked tokens have two labels than two tokens
        drawn alone."""
        n = np.array([[seen.get((name, str(i), j), 0) for j in range(LABELS)] for i in range(LABELS)], float)
        if name == "same":
            # The base patterns miss other forms of a number: a link from one
            # they know to one they don't says nothing against it.
            n[0, 1:] = n[1:, 0] = 0.0
        n = n + n.T + SMOOTH[name] + 5 * np.eye(LABELS)
        share = n / n.sum()
        return np.log(share) - np.log(np.outer(share.sum(axis=1), share.sum(axis=0)))

    return Field(unary, np.log(0.1 / (labels + 1)), np.log((labels + 1) / (labels + 1).sum()), ties("chain"), ties("skip"), ties("same"))


def added_spans(text: str, g: Graph, share: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of tokens that no base pattern has and whose marginal favours a
    kind; neighbours of one kind are one span, which must be plausible."""
    out: list[tuple[int, int, int]] = []
    linked: list[bool] = []  # a token shares its number with one observed as the kind
    chained = set(g.chain)
    reached = _reached(g)
    for i, (a, b) in enumerate(g.spans):
        kind = int(share[i].argmax())
        if g.observed[i] or not kind or share[i, kind] <= 0.5:
            continue
        if out and out[-1][0] == kind - 1 and (i - 1, i) in chained and out[-1][2] == g.spans[i - 1][1]:
            out[-1] = (kind - 1, out[-1][1], b)
            linked[-1] |= (i, kind) in reached
        else:
            out.append((kind - 1, a, b))
            linked.append((i, kind) in reached)
    return [x for x, known in zip(out, linked) if _plausible(x[0], text[x[1]:x[2]], known)]


def _reached(g: Graph) -> set[tuple[int, int]]:
    """(token, kind): links of equal numbers lead to one observed as it."""
    near: dict[int, list[int]] = {}
    for i, j in g.same:
        near.setdefault(i, []).append(j)
        near.setdefault(j, []).append(i)
    todo = [(i, g.observed[i]) for i in near if g.observed[i]]
    out = set(todo)
    while todo:
        i, kind = todo.pop()
        for j in near[i]:
            if (j, kind) not in out:
                out.add((j, kind))
                todo.append((j, kind))
    return out


def _plausible(kind: int, found: str, linked: bool) -> bool:
    """What a span of a kind must look like at least.  Looks alone make no
    phone number, and no card number that fails the checksum: these must also
    stand elsewhere in a form that the base patterns know."""
    digits = len(NOT_DIGIT.sub("", found))
    if kind == 0:
        return "@" in found
    if kind == 1:
        parts = re.split(r"[.:]", found)
        return len(parts) >= 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts[:4])
    if kind == 2:
        return 12 <= digits <= 19 and (linked or luhn(NOT_DIGIT.sub("", found)))
    return 7 <= digits <= 15 and linked


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def _in_groups(model: Field, graphs: list[Graph]) -> Iterator[np.ndarray]:
    """Marginals of each graph; about ``TOGETHER`` tokens at a time."""
    held: list[Graph] = []
    for g in graphs:
        if held and sum(len(x.spans) for x in held) + len(g.spans) > TOGETHER:
            yield from model.marginals(held)
            held = []
        held.append(g)
    yield from model.marginals(held)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Field | None = None, **fit_options) -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone (base spans),
    n_added, base_sha256, spans."""
    small_batches(docs.sparkSession)
    model = model or fit(docs, id_col, text_col, **fit_options)
    rows = docs.select(col(id_col).alias("__llm_id"), text_or_empty(text_col).alias("text"))
    names = [f"n_{k}" for k in KINDS] + ["n_added", "base_sha256", "spans"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base = [base_spans(t) for t in batch["text"]]
            graphs = [graph(t, b) for t, b in zip(batch["text"], base)]
            out = []
            for text, own, g, share in zip(batch["text"], base, graphs, _in_groups(model, graphs)):
                more = added_spans(text, g, share)
                n = [sum(s[0] == kind for s in own) for kind in range(len(KINDS))]
                out.append((*n, len(more), hashlib.sha256(_joined(own).encode()).hexdigest(), _joined(sorted(own + more))))
            found = pd.DataFrame(out, columns=names)
            found.insert(0, "__llm_id", batch["__llm_id"].to_numpy())
            yield found

    kind = rows.schema["__llm_id"].dataType.simpleString()
    schema = f"__llm_id {kind}, " + ", ".join(f"{x} long" for x in names[:5]) + ", base_sha256 string, spans string"
    return rows.mapInPandas(run, schema).withColumnRenamed("__llm_id", id_col)
