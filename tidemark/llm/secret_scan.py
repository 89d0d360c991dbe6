"""Operator 4: secret scan by fixed patterns and a battery of randomness tests.

Base spans come from three patterns: an assignment to a secret-like name, an
access key, and a long hexadecimal run.  The battery adds spans of kind
``random``: a run of 16 or more key characters is read in the smallest
encoding that holds all its characters, and must there pass a chi-squared test
of uniformity, a runs test and a test of serial correlation.

Passing such tests is weak evidence for a short run, so discoveries are
controlled as well.  Under the null a run is written with the corpus's own
character frequencies (counted over all texts); the likelihood ratio of
"uniform in its encoding" to that null, divided by the number of encodings, is
an e-value and grows with length.  The e-values of all runs of the corpus go
through the e-Benjamini-Hochberg rule, which keeps the share of false
discoveries below ``fdr``.  What reaches the driver is a table of byte counts
and a histogram of e-values, both of fixed size.

Defined results: a null text counts as empty; no match gives zero counts and
the digest of an empty string; a run that overlaps a base span adds nothing;
repeated rows are scanned alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, small_batches, text_or_empty

#: Base patterns and kinds, in the contract's order (fixed values).
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
#: Encodings from the smallest alphabet to the largest.
ENCODINGS = (
    DIGITS + "abcdef",
    DIGITS + "ABCDEF",
    LOWER,
    UPPER,
    UPPER + "234567",
    DIGITS + LOWER,
    DIGITS + UPPER,
    UPPER + LOWER,
    DIGITS + UPPER + LOWER,
    UPPER + LOWER + DIGITS + "+/",
    UPPER + LOWER + DIGITS + "-_",
    UPPER + LOWER + DIGITS + "+/-_",
)
PLACES = [{c: i for i, c in enumerate(alphabet)} for alphabet in ENCODINGS]
SETS = [frozenset(alphabet) for alphabet in ENCODINGS]
#: Resolution of the histogram of log e-values, and its end.
BIN, LAST_BIN = 0.25, 2_000


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_p(places: np.ndarray, size: int) -> float:
    """Uniformity over the alphabet, merged into as many equal classes as
    leave five expected characters each (Wilson-Hilferty approximation)."""
    n = len(places)
    classes = max(2, min(size, n // 5))
    group = np.arange(size) * classes // size
    share = np.bincount(group, minlength=classes) / size
    seen = np.bincount(group[places], minlength=classes)
    x = float(((seen - n * share) ** 2 / (n * share)).sum())
    free = classes - 1
    z = ((x / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs_p(places: np.ndarray, size: int) -> float:
    """Wald-Wolfowitz runs above and below the middle of the alphabet."""
    high = places * 2 >= size
    n, a = len(high), int(high.sum())
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * a * b / n + 1
    spread = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    return _normal_tail((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0


def serial_p(places: np.ndarray) -> float:
    """Lag-one correlation of neighbouring characters."""
    x = places - places.mean()
    power = float((x * x).sum())
    if power == 0:
        return 0.0
    n = len(x)
    r = float((x[1:] * x[:-1]).sum()) / power
    return _normal_tail((r + 1 / n) * math.sqrt(n))


def battery(run: str, level: float = 0.01) -> bool:
    """Whether the run looks random in its encoding, all tests taken together
    (each at a third of ``level``)."""
    body = run.rstrip("=")
    k = encoding(body)
    if k is None:
        return False
    size = len(ENCODINGS[k])
    places = np.array([PLACES[k][c] for c in body])
    each = level / 3
    return chi_squared_p(places, size) >= each and runs_p(places, size) >= each and serial_p(places) >= each


def encoding(body: str) -> int | None:
    used = set(body)
    return next((k for k, alphabet in enumerate(SETS) if used <= alphabet), None)


@dataclass
class Null:
    """Ordinary writing: the corpus's log frequency of each key character,
    case aside; letters all small, all capital or capitalised, a quarter of
    the weight each, and any mixture of cases the last quarter."""

    logs: dict[str, float]

    def log_e(self, run: str) -> float:
        body = run.rstrip("=")
        k = encoding(body)
        if k is None:
            return -math.inf
        logs = self.logs
        plain = body.islower() or body.isupper() or body.istitle()
        letters = sum(map(str.isalpha, body))
        cases = math.log(0.25) - (0 if plain or not letters else letters * math.log(2))
        null = sum([logs[c] for c in body.lower()]) + cases
        return -len(body) * math.log(len(ENCODINGS[k])) - null - math.log(len(ENCODINGS))


def learn_null(docs: DataFrame, text_col: str) -> Null:
    """Character frequencies over all texts."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        yield pd.DataFrame({"byte": np.arange(256), "n": total})

    counted = docs.select(text_or_empty(text_col).alias("text")).mapInPandas(count, "byte int, n long")
    seen = {r[0]: r[1] for r in counted.groupBy("byte").agg(F.sum("n")).collect()}
    alphabet = [c for c in ENCODINGS[-1] if c not in UPPER]
    n = {c: seen.get(ord(c), 0) + (seen.get(ord(c.upper()), 0) if c in LOWER else 0) + 1 for c in alphabet}
    total = sum(n.values())
    return Null({c: math.log(n[c] / total) for c in alphabet})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; kinds by their place in KINDS."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, null: Null) -> list[tuple[int, int, float]]:
    """(start, end, log e-value) of the runs that pass the battery."""
    out = []
    for m in RUN.finditer(text):
        value = null.log_e(m[0])
        if value > 0 and battery(m[0]):
            out.append((m.start(), m.end(), value))
    return out


def threshold(histogram: dict[int, int], tested: int, fdr: float) -> float:
    """e-Benjamini-Hochberg on a histogram of log e-values: with k values at
    or above the cut, the cut is at least log(tested / (k * fdr))."""
    best, above = math.inf, 0
    for k in sorted(histogram, reverse=True):
        above += histogram[k]
        if k * BIN >= math.log(max(tested, 1) / (above * fdr)):
            best = k * BIN
    return best


def calibrate(docs: DataFrame, text_col: str = "text", fdr: float = 0.01) -> tuple[Null, float]:
    """The null and the log e-value from which a run counts as a secret."""
    null = learn_null(docs, text_col)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins: dict[int, int] = {}
        for batch in batches:
            for text in batch["text"]:
                for m in RUN.finditer(text):
                    value = null.log_e(m[0])
                    k = -1 if value <= 0 or not battery(m[0]) else min(int(value / BIN), LAST_BIN)
                    bins[k] = bins.get(k, 0) + 1
        yield pd.DataFrame({"bin": list(bins), "n": list(bins.values())}, dtype="int64")

    counted = docs.select(text_or_empty(text_col).alias("text")).mapInPandas(count, "bin long, n long")
    seen = {r[0]: r[1] for r in counted.groupBy("bin").agg(F.sum("n")).collect()}
    tested = sum(seen.values())
    seen.pop(-1, None)
    return null, threshold(seen, tested, fdr)


def all_spans(text: str, null: Null, cut: float) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, base and added spans), each sorted by start, then kind."""
    base = base_spans(text)
    added, at, reach = [], 0, 0
    if cut < math.inf:
        for start, end, value in candidates(text, null):
            while at < len(base) and base[at][0] < end:
                reach = max(reach, base[at][2])
                at += 1
            if value >= cut and reach <= start:
                added.append((start, 3, end))
    return base, sorted(base + added)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.01) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, n_random,
    base_sha256, spans."""
    null, cut = calibrate(docs, text_col, fdr)
    rows = docs.select(col(id_col).alias("__llm_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                base, spans = all_spans(text, null, cut)
                n = [sum(s[1] == kind for s in spans) for kind in range(4)]
                out.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            found = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])
            found.insert(0, "__llm_id", batch["__llm_id"].to_numpy())
            yield found

    kind = rows.schema["__llm_id"].dataType.simpleString()
    schema = f"__llm_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return rows.mapInPandas(run, schema).withColumnRenamed("__llm_id", id_col)


def masked(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each span, or run of overlapping spans, replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", mark: str = "[SECRET]", fdr: float = 0.01) -> DataFrame:
    """The documents with every secret replaced by ``mark``; all rows and
    columns stay, and ``length_col``, if there is one, follows the new text."""
    null, cut = calibrate(docs, text_col, fdr)

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([t if t is None else masked(t, all_spans(t, null, cut)[1], mark) for t in texts], dtype=object)

    new = "__llm_text"
    found = docs.withColumn(new, mask(col(text_col).cast("string")))
    changed = ~F.col(new).eqNullSafe(col(text_col).cast("string"))

    def kept(name: str) -> Column:
        if name == text_col:
            return F.when(changed, F.col(new)).otherwise(col(name)).alias(name)
        if name == length_col:
            return F.when(changed, F.char_length(new).cast(docs.schema[name].dataType)).otherwise(col(name)).alias(name)
        return col(name)

    return found.select(*[kept(name) for name in docs.columns])
