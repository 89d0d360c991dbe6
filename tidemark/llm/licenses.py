"""Operator 7: licence scan by canonical digests of entire texts.

A text is brought to a canonical form (lower case, its paragraphs unwrapped,
without copyright notices, equivalent spellings made one, every run of other
signs than letters and digits one space), and its digest is joined by hash
with those of the known licences in the same form.  A notice is a copyright
word with a year, a sign or a holder, up to the end of its sentence or
paragraph or to the licence's own first words.  The texts that are looked up
are each document as a whole and each of its lines, so a licence statement
inside a document is found if it makes up a line of its own.

Most lines are no licence, and that can be seen without bringing them to form:
of a few words found from the known forms, each form holds at least one
(:func:`signs_of`).  No step of the canonical form makes such a word out of
something else, so a text or line without any of them has no known form,
whatever the table; only the others are brought to form.

The known licences are a parameter (licence, text); the digests of the default
ones are a table of fixed size.  DataFrame functions only.

Defined results: a null text counts as empty; an empty canonical form matches
nothing; a text under several names in the known table has the smallest; a
document's licences are distinct and sorted; repeated rows are scanned alike;
an empty table gives no rows.
"""

from __future__ import annotations

import json
import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ID, KEY_A, KEY_B, col, keyed, text_or_empty

#: What begins a line that the query's SQL leaves out; the operator leaves out
#: notices instead, with equal results on tables whose lines are unwrapped.
COPYRIGHT = r"(?m)^[ \t#*/;-]*(copyright|\(c\)|©)[^\n]*$"
#: A line's end, with blanks before it and comment signs after it.
LINE_END = r"[ \t\r]*\n[ \t\r#*/;>%-]*"
#: Where a notice ends: at the paragraph's or sentence's end (not at an initial
#: or a firm's short form), or before words that a licence begins with.
_NOTICE_END = (
    r"[^\n]*?(?:(?<!\b[a-z]|\b(?:inc|ltd|llc|corp|co|jr|sr|dr|st|al))[.!?](?=\s|$)|(?=\n|$)"
    r"|(?=\b(?:all rights reserved|permission (?:is|to)|redistribution and|licen[cs]ed under|released under|everyone is permitted"
    r"|this (?:program|library|work|software|file|code|project|document|is free|source)|the above copyright"
    r"|(?:mit|isc|bsd|apache) licen[cs]e|the (?:mit|isc|bsd) licen[cs]e|use of this|use, modification|you may)\b))"
    r"(?:\s*all rights reserved\b\.?)?"
)
#: A notice by sign, year or placeholder, wherever it stands.
NOTICE = (
    r"(?:\bcopyright\b[ :]*(?:\(c\)|©|&copy;|(?:by )?[0-9]{4}\b|[<\[{])|(?:\(c\)|©|&copy;) *(?:copyright *)?[0-9]{4}\b|©|&copy;)" + _NOTICE_END
)
#: A notice by its holder alone begins a line; after these words "copyright"
#: begins no notice but belongs to a licence's own text.
HELD = (
    r"(?m)^[ \t#*/;>%-]*copyright[ :]+(?=[a-z])(?!(?:holder|owner|notice|law|licen[cs]e|act|statement|right|interest|permission|protection"
    r"|disclaimer|infringement|treat|material|work|claim|status|year|grant|condition|and|or|in|on|of|to|for|is|are|as|under|applicable"
    r"|by applicable|the software|the library|the program|if|doctrine|ownership|including|resulting"
    r"|subsist|protected|that|which|with|where|may|shall|will|it)(?:s|y|ies)?\b)"
)
#: Equivalent spellings, applied in this order (fixed values).
SPELLINGS = (
    (r"licen[cs]e", "license"),
    (r"sub-license", "sublicense"),
    (r"non-commercial", "noncommercial"),
    (r"non-infringement", "noninfringement"),
    (r"\bper cent\b", "percent"),
    (r"https?://(www\.)?", ""),
    (r"&", " and "),
    (r"\bgnu general public license\b", "gpl"),
    (r"\bversion ([0-9])", r"v$1"),
    (r"\bv([0-9]+)\.0\b", r"v$1"),
)
OTHERS = r"[^a-z0-9]+"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

#: Known licences and notices (fixed values), those that the SQL knows;
#: ``default_texts`` has more.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", _ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License\n\n" + _MIT),
)


def _unwrapped(text: Column, sign: Column) -> Column:
    """One line for each paragraph; a notice by its holder becomes one."""
    out = F.regexp_replace(text, LINE_END, "\n")
    out = F.when(sign, F.regexp_replace(out, HELD, "\n\ncopyright ")).otherwise(out)
    return F.regexp_replace(F.regexp_replace(out, r"(?<=[a-z])-\n(?=[a-z])", "-"), r"(?<!\n)\n(?!\n)", " ")


def canonical(text: Column, one_line: bool = False) -> Column:
    """``one_line``: the text is known to have no line ends."""
    lower = F.lower(text)
    sign = lower.contains("copyright") | lower.contains("(c)") | lower.contains("©") | lower.contains("&copy;")
    out = lower if one_line else _unwrapped(lower, sign)
    out = F.when(sign, F.regexp_replace(F.regexp_replace(out, HELD + _NOTICE_END, " "), NOTICE, " ")).otherwise(out)
    for found, same in SPELLINGS:
        out = F.regexp_replace(out, found, same)
    return F.trim(F.regexp_replace(out, OTHERS, " "))


#: What the spellings make out of other text, and how that text shows: a form's
#: word with the left side in it stands for a text with the right side in it.
MADE = (("license", "licen"),)
#: Words that a spelling may make, or take a part from, in another way.
NEVER = frozenset(("noncommercial", "noninfringement", "percent", "gpl", "and", "http", "https", "www"))


def signs_of(forms: list[str]) -> list[str]:
    """A few pieces of lower-case text such that each text with one of the
    canonical ``forms`` holds at least one of them: a greedy cover by words of
    five letters or more.  Empty if some form has no such word."""
    holders: dict[str, set[int]] = {}
    for i, form in enumerate(forms):
        for word in set(form.split(" ")):
            if len(word) >= 5 and word.isalpha() and word not in NEVER:
                shown = next((b for a, b in MADE if a in word), word)
                holders.setdefault(shown, set()).add(i)
    left, out = set(range(len(forms))), []
    while left:
        best = max(holders, key=lambda w: (len(holders[w] & left), w), default=None)
        if best is None or not holders[best] & left:
            return []
        out.append(best)
        left -= holders[best]
    return out


def _any_of(text: Column, signs: list[str]) -> Column:
    """Whether a lower-case text holds one of the signs.  An address's
    beginning is dropped without a space, which might join two parts of a
    word, so a text with one is always looked at."""
    found = F.lit(not signs) | text.contains("http://") | text.contains("https://") if signs else F.lit(True)
    for sign in signs:
        found = found | text.contains(sign)
    return found


def digest(text: Column, one_line: bool = False) -> Column:
    """Digest of the canonical form; null if nothing is left of the text."""
    form = canonical(text, one_line)
    return F.when(form != "", F.sha2(form, 256))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, licence) of known (licence, text)."""
    return known.select(digest(F.col("text")).alias("digest"), "licence").filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("licence").alias("licence")
    )


def default_texts() -> list[tuple[str, str]]:
    """(licence, text) of ``KNOWN`` and of the data file beside this module:
    the common licences whole, and their usual notices."""
    return [*KNOWN, *map(tuple, json.loads(pkgutil.get_data(__package__, "known_licences.json")))]


def default_known(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(default_texts(), "licence string, text string")


def known_forms(spark: SparkSession) -> list[str]:
    """The canonical forms of the default texts (a fixed, small table)."""
    return [r[0] for r in default_known(spark).select(canonical(F.col("text"))).distinct().collect() if r[0]]


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, licence (the whole text's), n_lines (lines
    that are a known text), licences (of text and lines, comma-joined).

    The default table's few digests are broadcast; a given table is joined by
    hash, adaptive execution decides from its measured size, and all lines are
    brought to form, as its forms may be too many to look for words in."""
    spark = docs.sparkSession
    digests = F.broadcast(known_digests(default_known(spark))) if known is None else known_digests(known)
    signs = signs_of(known_forms(spark)) if known is None else []
    text = text_or_empty(text_col)
    lower = F.lower(text)
    key = [col(id_col).alias(ID), *keyed(text_col)]
    # One digest for the text and one for each line, of those that show a sign.
    lines = F.filter(F.split(lower, "\n"), lambda line: _any_of(line, signs))
    units = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), digest(lower).alias("digest"))),
        F.transform(lines, lambda line: F.struct(F.lit(False).alias("whole"), digest(line, True).alias("digest"))),
    )
    found = (
        docs.filter(_any_of(lower, signs)).select(*key, F.explode(units).alias("u")).select(ID, KEY_A, KEY_B, "u.*").filter("digest IS NOT NULL")
        # Copies of a document share id and text; lines are counted per copy.
        .join(digests, "digest")
        .groupBy(ID, KEY_A, KEY_B)
        .agg(
            F.min(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
            F.count_if(~F.col("whole")).alias("lines"),
            F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
        )
    ).alias("f")
    rows = docs.select(*key)
    copies = rows.groupBy(ID, KEY_A, KEY_B).agg(F.count("*").alias("copies")).alias("r")
    joined = copies.join(
        found,
        F.col(f"r.{ID}").eqNullSafe(F.col(f"f.{ID}"))
        & (F.col(f"r.{KEY_A}") == F.col(f"f.{KEY_A}"))
        & (F.col(f"r.{KEY_B}") == F.col(f"f.{KEY_B}")),
        "left",
    )
    each = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return each.select(
        F.col(f"r.{ID}").alias(id_col),
        "licence",
        (F.coalesce("lines", F.lit(0)) / F.col("copies")).cast("long").alias("n_lines"),
        F.coalesce("licences", F.lit("")).alias("licences"),
    )
