"""Registered queries of this subpackage: each applies one operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, divergence, exact_dedup, html_extract, langid, licenses, packing, pii, prefix_trie, secret_scan, sharding, simhash, topk
from tidemark.sources.tables import table_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_documents(spark, sf_dir))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(table_path(sf_dir, "embeddings")))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_documents(spark, sf_dir))


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(_documents(spark, sf_dir))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(table_path(sf_dir, "pages")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(_documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(table_path(sf_dir, "conversations")))


def op13_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_documents(spark, sf_dir))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_topk": op2_exact_topk,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_pii": op5_pii,
    "op6_pattern_packing": op6_pattern_packing,
    "op7_license_scan": op7_license_scan,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_html_extract": op9_html_extract,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_slot_sharding": op13_slot_sharding,
}

_OP8 = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), g AS (
    SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
           first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""



def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{licenses.COPYRIGHT}', ' ', 'g')"
    for found, same in licenses.SPELLINGS:
        out = f"regexp_replace({out}, '{found}', '{same.replace('$', chr(92))}', 'g')"
    return f"trim(regexp_replace({out}, '{licenses.OTHERS}', ' ', 'g'))"


def _known_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    return ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.KNOWN)


_OP7 = f"""
WITH k AS (
    SELECT {_canonical_sql('text')} AS form, min(licence) AS licence FROM (VALUES {_known_sql()}) v(licence, text) GROUP BY 1
), u AS (
    SELECT doc_id, true AS whole, coalesce(text, '') AS unit FROM documents
    UNION ALL
    SELECT doc_id, false, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents
), f AS (
    SELECT u.doc_id, min(CASE WHEN whole THEN licence END) AS licence, count(*) FILTER (NOT whole) AS n_lines,
           string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
    FROM u JOIN k ON {_canonical_sql('unit')} = form AND form <> ''
    GROUP BY u.doc_id
)
SELECT d.doc_id, f.licence, coalesce(f.n_lines, 0) AS n_lines, coalesce(f.licences, '') AS licences
FROM documents d LEFT JOIN f USING (doc_id)
"""

_OP2 = """
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) for x in embedding])
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP11 = r"""
WITH d AS (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
    SELECT i, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM d
), c AS (
    SELECT lang, source, term, count(*)::HUGEINT AS n, count(DISTINCT i) AS docs FROM t GROUP BY ALL
), k AS (
    SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(docs) >= 10
), l AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(total) AS m FROM k GROUP BY lang
), g AS (
    SELECT DISTINCT lang, source FROM d
), x AS (
    SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS own
    FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
    SELECT x.*, 1 + (1000000000 * (n + 2)) // (own + 2 * v) AS p, 1 + (1000000000 * (total + 2)) // (m + 2 * v) AS q
    FROM x JOIN l USING (lang)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
), terms AS (
    SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms
) WHERE rank <= 10
"""

#: CRC-32 of a decimal number: bit by bit, over the codes of its digits.
_CRC = """list_reduce([4294967295::UBIGINT] || [ord(x)::UBIGINT for x in string_split(c::VARCHAR, '')],
        lambda v, b: list_reduce([xor(v, b)] || [0::UBIGINT for i in range(8)], lambda r, z: xor(r >> 1, 3988292384 * (r & 1))))"""
_OP12 = f"""
WITH t AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL
), o AS (
    SELECT c, list({{'d': digest, 'n': strlen(text)}} ORDER BY turn NULLS FIRST, digest) AS own FROM t GROUP BY c
), h AS (
    SELECT *, (xor({_CRC}, 4294967295) % 9)::INT AS h FROM o
), r AS (
    SELECT h.c, coalesce(list_slice(b.own, 1, h.h), []) || coalesce(list_slice(h.own, h.h + 1, len(h.own)), []) AS seq
    FROM h LEFT JOIN o b ON b.c = h.c - h.c % 5
), n AS (
    SELECT [x.d for x in list_slice(seq, 1, d)] AS path, d, min(c) AS conv_id, count(*) AS n_convs,
           any_value(CASE WHEN d > 0 THEN seq[d].n ELSE 0 END) AS size,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(seq) = d), '')) AS ends_sha256
    FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM r) GROUP BY 1, 2
), k AS (
    SELECT p.path, count(x.path) AS n_children
    FROM n p LEFT JOIN n x ON x.d = p.d + 1 AND list_slice(x.path, 1, p.d) = p.path GROUP BY p.path
), a AS (
    SELECT list_slice(n.path, 1, d0) AS path, count(*) FILTER (k.n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved
    FROM n JOIN k USING (path), LATERAL (SELECT unnest(range(n.d + 1)) AS d0) GROUP BY 1
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, k.n_children, a.n_leaves,
       a.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN k USING (path) JOIN a USING (path) LEFT JOIN n p ON n.d > 0 AND p.d = n.d - 1 AND p.path = list_slice(n.path, 1, n.d - 1)
"""

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_exact_topk": _OP2,
    "op7_license_scan": _OP7,
    "op8_exact_dedup": _OP8,
    "op11_source_divergence": _OP11,
    "op12_prefix_trie": _OP12,
}
