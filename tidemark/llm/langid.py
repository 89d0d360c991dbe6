"""Operator 1: language identification by word-first backoff.

A known word adds its log frequency in each language.  A word that was not
learned is scored by its character n-grams: at each position the longest
learned n-gram (4, 3, 2, then 1 letters) that ends there counts, and the word
adds the mean over its positions.  The language with the highest sum wins;
``score`` is its share after a softmax over the languages.

The model is fitted on a bounded, hash-chosen sample of labelled rows
(``max_train_docs``, dealt evenly over the languages) and keeps all of its
words and n-grams, so its size does not grow with the corpus and it may be
broadcast.  Every text is predicted whole.

Defined results: a null text, an empty text and a text without letters give
``und`` with score 0.0; equal scores go to the smaller language code; with no
labelled row every text gives ``und``; repeated rows are predicted alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, shared, small_batches, text_or_empty, value_of, worker_cache

UNDETERMINED = "und"
ORDERS = (4, 3, 2, 1)
BACKOFF = math.log(0.4)
#: Scored words a Python worker keeps between documents.
CACHED_WORDS = 150_000
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    floor: np.ndarray


def held_out(id_col: str) -> Column:
    """Rows kept away from training: crc32 of the id's text, modulo 3, is 1."""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _sample(train: DataFrame, id_col: str, lang_col: str, max_train_docs: int) -> DataFrame:
    """At most about ``max_train_docs`` rows: each language gives its share,
    picked by a hash of the id, and a rarer language gives all it has."""
    counts = {r[0]: r[1] for r in train.groupBy(col(lang_col)).count().collect()}
    if not counts:
        return train
    share, span = max_train_docs / len(counts), 1 << 20
    rates = F.create_map(*[
        F.lit(x) for lang, n in counts.items() for x in (lang, math.ceil(min(1.0, share / n) * span))
    ])
    dealt = F.pmod(F.xxhash64(F.lit("langid"), col(id_col).cast("string")), F.lit(span))
    return train.filter(dealt < rates[col(lang_col)])


def _table(counts: DataFrame, key: str, langs: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """The keys and their counts by language, of the bounded sample."""
    wide = counts.groupBy(key).agg(
        *[F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(langs)],
    )
    rows = wide.toPandas().sort_values(key, ignore_index=True)
    return {k: i for i, k in enumerate(rows[key])}, rows[[f"n{i}" for i in range(len(langs))]].to_numpy(float).reshape(-1, len(langs))


def _pieces(padded: Column, k: int) -> Column:
    """The n-grams of ``k`` letters of a word, none if it is shorter."""
    at = F.filter(F.sequence(F.lit(1), F.length(padded)), lambda i: i <= F.length(padded) - k + 1)
    return F.transform(at, lambda i: F.substring(padded, i, F.lit(k)))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_train_docs: int = 4_000,
) -> Model | None:
    """Learn from the labelled rows that are not held out (None without any).
    The counts are Spark aggregations; what reaches the driver are the words
    and n-grams of ``max_train_docs`` documents."""
    labelled = docs.filter(col(lang_col).isNotNull() & col(text_col).isNotNull() & ~held_out(id_col))
    train = _sample(labelled, id_col, lang_col, max_train_docs)
    words = (
        train.select(
            col(lang_col).alias("lang"),
            F.explode(F.regexp_extract_all(F.lower(col(text_col)), F.lit(r"\p{L}+"), F.lit(0))).alias("word"),
        )
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    ).persist()
    try:
        totals = {r[0]: r[1] for r in words.groupBy("lang").agg(F.sum("n")).collect()}
        langs = sorted(totals)
        if not langs:
            return None
        known, word_counts = _table(words, "word", langs)
        padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
        pieces = F.flatten(F.array(*[_pieces(padded, k) for k in ORDERS]))
        grams = words.select("lang", "n", F.explode(pieces).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        known_grams, gram_counts = _table(grams, "gram", langs)
    finally:
        words.unpersist()
    total = np.array([totals[x] for x in langs], float)
    word_logs = np.log((word_counts + 0.5) / (total + 0.5 * len(known)))
    # Each n-gram against those of its own length, in its language.
    gram_logs = np.zeros_like(gram_counts)
    lengths = np.array([len(g) for g in known_grams])
    for k in ORDERS:
        own = lengths == k
        if own.any():
            part = gram_counts[own] + 0.5
            gram_logs[own] = np.log(part / part.sum(axis=0))
    floor = np.full(len(langs), gram_logs.min() if len(gram_logs) else -20.0)
    return Model(langs, known, word_logs, known_grams, gram_logs, floor)


class _Scorer:
    """Rows of scores by word: the learned words, then unseen ones as met."""

    def __init__(self, model: Model):
        self.model = model
        self.chars = {c: i for i, c in enumerate(sorted({c for g in model.grams for c in g}), 1)}
        self.by_order = {}
        for k in ORDERS:
            own = [(self.key(g), i) for g, i in model.grams.items() if len(g) == k]
            own.sort()
            self.by_order[k] = np.array([x[0] for x in own], np.uint64), np.array([x[1] for x in own], np.int64)
        self.logs = np.vstack([model.gram_logs, model.floor])
        self.reset()

    def key(self, gram: str) -> int:
        out = 0
        for c in gram:
            out = out << 16 | self.chars[c]
        return out

    def reset(self) -> None:
        known = len(self.model.words)
        self.at = dict(self.model.words)
        self.rows = self.model.word_logs
        self.n = known

    def unseen(self, words: list[str]) -> np.ndarray:
        """Mean over each word's positions of its longest learned n-gram."""
        text = "".join(f"^{w}$" for w in words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds, back = np.unique(points, return_inverse=True)
        code = np.array([min(self.chars.get(chr(c), 0), 0xFFFF) for c in kinds], np.uint64)[back]
        size = np.array([len(w) + 2 for w in words])
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        inside = np.arange(len(points)) - np.repeat(first, size)
        found = np.full(len(points), len(self.logs) - 1)
        step = np.zeros(len(points))
        todo = np.flatnonzero(inside >= 1)
        for lost, k in enumerate(ORDERS):
            keys, places = self.by_order[k]
            if not len(keys) or not len(todo):
                continue
            long = todo[inside[todo] >= k - 1]
            gram = np.zeros(len(long), np.uint64)
            for back_by in range(k - 1, -1, -1):
                gram = gram << np.uint64(16) | code[long - back_by]
            at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
            hit = keys[at] == gram
            found[long[hit]] = places[at[hit]]
            step[long[hit]] = lost * BACKOFF
            todo = todo[found[todo] == len(self.logs) - 1]
        scores = self.logs[found] + step[:, None]
        scores[inside == 0] = 0.0
        return np.add.reduceat(scores, first, axis=0) / (size - 1)[:, None]

    def learn(self, words: list[str]) -> None:
        """Room and scores for words not met before."""
        if self.n + len(words) > len(self.rows):
            grown = np.empty((self.n + max(CACHED_WORDS, len(words)), len(self.model.langs)))
            grown[:self.n] = self.rows[:self.n]
            self.rows = grown
        for start in range(0, len(words), 20_000):
            part = words[start:start + 20_000]
            self.rows[self.n:self.n + len(part)] = self.unseen(part)
            self.at.update(zip(part, range(self.n, self.n + len(part))))
            self.n += len(part)

    def scores(self, texts: Iterable[str | None]) -> list[np.ndarray | None]:
        """Sums by language for each text; None where there is no letter."""
        if self.n > len(self.model.words) + CACHED_WORDS:
            self.reset()
        counted = []
        for text in texts:
            found = WORD.findall(text.lower()) if text else []
            counted.append(Counter(found) if any(c.isalpha() for w in found for c in w) else None)
        known = self.at
        self.learn(list({w for c in counted if c for w in c if w not in known}))
        get = self.at.__getitem__
        return [
            None if c is None else np.fromiter(c.values(), float, len(c)) @ self.rows[np.fromiter(map(get, c), np.int64, len(c))]
            for c in counted
        ]


def predictor(model: Model | None, spark) -> callable:
    """A vectorised function: text -> struct(lang, score)."""
    small_batches(spark)
    sent = shared(spark, model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        learned = value_of(sent)
        cache = worker_cache("langid")
        if cache.get("model") is not learned:
            cache.clear()
            cache.update(model=learned, scorer=_Scorer(learned) if learned else None)
        scorer = cache["scorer"]
        for texts in batches:
            out = []
            for sums in scorer.scores(texts) if scorer else [None] * len(texts):
                if sums is None:
                    out.append((UNDETERMINED, 0.0))
                    continue
                best = int(np.argmax(sums))
                out.append((learned.langs[best], float(1.0 / np.exp(sums - sums[best]).sum())))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return predict


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    model: Model | None = None,
    **fit_options,
) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    model = model or fit(docs, id_col, text_col, lang_col, **fit_options)
    predict = predictor(model, spark)
    return docs.select(
        col(id_col), held_out(id_col).alias("held_out"), predict(text_or_empty(text_col)).alias("p")
    ).select(col(id_col), "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language could be told, with all their columns
    (rejected: no letters, or no language above even odds)."""
    predict = predictor(fit(docs, id_col, text_col, lang_col), docs.sparkSession)
    mark = "__llm_lang"
    judged = docs.withColumn(mark, predict(text_or_empty(text_col)))
    return judged.filter((F.col(f"{mark}.lang") != UNDETERMINED) & (F.col(f"{mark}.score") >= 0.5)).drop(mark)
