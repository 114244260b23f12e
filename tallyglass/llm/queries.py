"""Queries over the operators of this package and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.llm import (
    bpe,
    decontamination,
    exact_dedup,
    html_text,
    license_scan,
    language_id,
    sentence_pieces,
    simhash,
    source_divergence,
    token_counts,
    token_output,
    vector_codes,
    warc,
)
from tallyglass.llm.common import table, tokenizer_path
from tallyglass.session import shared_folder


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer_path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.round_trip(docs, vocabulary, bpe.build_lexicon(docs, vocabulary))
    return tokens.selectExpr(
        "doc_id",
        "n_tokens",
        "sha2(array_join(ids, ','), 256) AS ids_sha256",
        "sha2(decoded, 256) AS decoded_sha256",
    )


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    token_output.write_tokens(docs, folder, tokenizer_path("word_bpe_49k.json"), vocabulary=49_408)
    written = token_output.read_tokens(spark, folder)
    return written.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.with_language(docs)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(table(spark, sf_dir, "documents"), tests)
    return found.selectExpr(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "sha2(array_join(items, ','), 256) AS items_sha256",
        "contaminated",
    )


OP8_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS words
  FROM item, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM win
), place AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
  FROM doc, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)
), hit AS (SELECT doc_id, i, n, item_id FROM place JOIN win USING (n, words)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS t(k) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archived_captures(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), first AS (
  SELECT *, CASE WHEN payload_bytes >= 100
            THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_page FROM page
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_page = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_page <> page_id THEN first_page END AS refers_to
FROM first
"""


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda index: F.lower(F.lpad(F.hex(index), 2, "0")))
    return vector_codes.with_label_error(coded).select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


_OP11_FIRST = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
  SELECT vec_id, k, list_slice(v, k * len(v) // 4 + 1, (k + 1) * len(v) // 4) AS p
  FROM kept, unnest(range(0, 4)) AS t(k)
), book0 AS MATERIALIZED (
  SELECT k, row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS e, p AS c
  FROM part WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
)"""
_OP11_NEAREST = """, near{r} AS MATERIALIZED (
  SELECT vec_id, k, p, min((d, e)) AS best FROM (
    SELECT vec_id, k, p, e, list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM part JOIN book{r} USING (k)
  ) GROUP BY vec_id, k, p
)"""
_OP11_MOVED = """, sum{n} AS (
  SELECT k, best[2] AS e, j, sum(p[j]) AS s, count(*) AS n
  FROM near{r}, unnest(range(1, len(p) + 1)) AS t(j) GROUP BY k, e, j
), mean{n} AS (
  SELECT k, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM sum{n} GROUP BY k, e
), book{n} AS MATERIALIZED (
  SELECT k, e, coalesce(m.c, b.c) AS c FROM book{r} AS b LEFT JOIN mean{n} AS m USING (k, e)
)"""
_OP11_LAST = """, coded AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY k) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM near4 GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY k, e)) AS codebooks_sha256 FROM book4
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""
OP11_SQL = (
    _OP11_FIRST
    + "".join(_OP11_NEAREST.format(r=r) + _OP11_MOVED.format(r=r, n=r + 1) for r in range(4))
    + _OP11_NEAREST.format(r=4)
    + _OP11_LAST
)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = sentence_pieces.round_trip(docs, tokenizer_path("piece_bpe_32k.model"))
    return pieces.selectExpr(
        "doc_id",
        "n_tokens",
        "sha2(array_join(ids, ','), 256) AS ids_sha256",
        "sha2(decoded, 256) AS decoded_sha256",
        "xxhash64(first_bytes, last_bytes) AS spans_hash",
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH doc AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), word AS (SELECT lang, source, row, unnest(w) AS term FROM doc
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), sized AS (
  SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang FROM doc) LEFT JOIN kept USING (lang) GROUP BY lang
), found AS (
  SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), grp AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN found USING (lang, source) GROUP BY lang, source
), cell AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
         1 + 1000000000 * (coalesce(f.n, 0) + 2)::HUGEINT // (g.total + 2 * s.v)::HUGEINT AS p,
         1 + 1000000000 * (k.n + 2)::HUGEINT // (s.total + 2 * s.v)::HUGEINT AS q
  FROM grp AS g JOIN sized AS s ON g.lang = s.lang JOIN kept AS k ON k.lang = g.lang
  LEFT JOIN found AS f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM cell AS a JOIN cell AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), result AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM cell WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM result
) WHERE part = 'pair' OR rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_bpe": op2_bpe,
        "op3_token_output": op3_token_output,
        "op4_language_id": op4_language_id,
        "op5_token_counts": op5_token_counts,
        "op6_license_scan": op6_license_scan,
        "op7_html_text": op7_html_text,
        "op8_decontamination": op8_decontamination,
        "op9_simhash": op9_simhash,
        "op10_warc": op10_warc,
        "op11_vector_codes": op11_vector_codes,
        "op12_sentencepiece": op12_sentencepiece,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1_SQL,
        "op8_decontamination": OP8_SQL,
        "op10_warc": OP10_SQL,
        "op11_vector_codes": OP11_SQL,
        "op13_source_divergence": OP13_SQL,
    }
