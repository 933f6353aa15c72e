"""The operators' registered queries, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skewkit.llm import (
    chat, decontaminate, filter_audit, fuzzyhash, html_extract, jaccard_join, langid, licenses, lm_scoring, packing, quality, token_alignment,
    token_files,
)
from skewkit.llm.common import read_table
from skewkit.session import scratch_path

#: End-of-document ids that the contracts of op8 and op10 name.
WORD_BPE_END, BYTE_BPE_END = 2, 1


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return leaks.drop("differing_bits")      # of the fingerprints; SQL has the rest


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_files.write_ids(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"),
                          WORD_BPE_END, special_tokens=True)
    return token_files.read_digests(spark, path)


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzyhash.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        BYTE_BPE_END, special_tokens=True)


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(read_table(spark, sf_dir, "documents"))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_ngram_jaccard_join, op3_benchmark_decontamination, op4_language_id, op5_chat_formatting,
    op6_license_scans, op7_quality_classifier, op8_token_ids, op9_document_fingerprints, op10_packing,
    op11_lm_scoring, op12_filter_interaction_audit, op13_token_alignment)}

#: All pairs of shingle sets by an equality join, then the classes by a recursive closure.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\t\n\x0b\x0c\r ]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, unnest(s) AS s FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
pairs AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 10 * c >= 8 * (len(x.s) + len(y.s) - c)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
classes AS (SELECT node AS doc_id, min(root) AS class_id FROM reach GROUP BY node),
degrees AS (SELECT a AS doc_id, count(*) AS n FROM links GROUP BY a)
SELECT c.doc_id, c.class_id, coalesce(d.n, 0) AS n_links FROM classes c LEFT JOIN degrees d USING (doc_id)
"""

#: Every window that starts with a shingle of an item of its size (or ends with the text), by counts of its shingles.
LEAKS_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\t\n\x0b\x0c\r ]+'), lambda x: x <> '') AS w
  FROM texts),
items AS (SELECT id, w, least(len(w), 5) AS k, len(w) - least(len(w), 5) + 1 AS m FROM words WHERE kind = 'i' AND len(w) > 0),
item_shingles AS (
  SELECT id, k, m, unnest(list_transform(range(1, m + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM items),
item_counts AS (SELECT id, k, m, s, count(*) AS c FROM item_shingles GROUP BY ALL),
docs AS (SELECT id, w, k, len(w) - k + 1 AS d FROM words, (SELECT DISTINCT k FROM items) WHERE kind = 'd' AND len(w) >= k),
doc_shingles AS (
  SELECT id, k, d, unnest(range(d)) AS p,
    unnest(list_transform(range(1, d + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM docs),
starts AS (
  SELECT DISTINCT g.id, g.k, g.d, c.m, least(g.p, greatest(g.d - c.m, 0)) AS a
  FROM doc_shingles g JOIN item_counts c ON c.k = g.k AND c.s = g.s),
windows AS (
  SELECT t.id, t.k, t.d, t.m, t.a, g.s, count(*) AS c
  FROM starts t JOIN doc_shingles g ON g.id = t.id AND g.k = t.k AND g.p >= t.a AND g.p < t.a + t.m GROUP BY ALL),
common AS (
  SELECT w.id AS doc_id, c.id AS item_id, w.k, w.m, w.a, least(w.m, w.d) AS size, CAST(sum(least(w.c, c.c)) AS BIGINT) AS b
  FROM windows w JOIN item_counts c ON c.k = w.k AND c.m = w.m AND c.s = w.s GROUP BY ALL),
scored AS (SELECT *, CAST(b AS DOUBLE) / CAST(size + m - b AS DOUBLE) AS similarity FROM common),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, a) AS place
  FROM scored WHERE similarity >= 0.8 - 1e-12)
SELECT doc_id, item_id, similarity, a AS start_word, size + k - 1 AS n_words FROM best WHERE place = 1
"""

#: The figures of each step from the fails of each document, order by order; no tensor.
AUDIT_SQL = r"""
WITH texts AS (
  SELECT d.doc_id, coalesce(d.source, '') AS part, coalesce(d.text, '') AS t,
    coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM documents d LEFT JOIN (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
words AS (
  SELECT x.*, f.first_id, list_filter(regexp_split_to_array(x.t, '[\t\n\x0b\x0c\r ]+'), lambda w: w <> '') AS w
  FROM texts x JOIN firsts f ON f.t = x.t),
fails AS (
  SELECT part, good, toxic, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e
  FROM words),
cells AS (
  SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, a::int + b::int + c::int + d::int + e::int AS n_fails,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, a, b, c, d, e),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
marked AS (
  SELECT c.part, s.o, s.step, c.n, c.good, c.toxic, c.n_fails, c.f[s.o[s.step]] AS own,
    len(list_filter(s.o[1:s.step - 1], lambda x: c.f[x])) > 0 AS gone
  FROM cells c, steps s),
figures AS (
  SELECT part, o, step, coalesce(sum(n) FILTER (NOT gone AND NOT own), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND own), 0) AS removed, coalesce(sum(n) FILTER (gone AND own), 0) AS redundant,
    coalesce(sum(n) FILTER (own AND n_fails = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND own), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND own), 0) AS toxic_lost
  FROM marked GROUP BY part, o, step)
SELECT part, array_to_string(o, '') AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley
FROM figures
"""

ORACLE_SQL: dict[str, str] = {"op12_filter_interaction_audit": AUDIT_SQL, "op3_benchmark_decontamination": LEAKS_SQL, "op2_ngram_jaccard_join": JACCARD_SQL}
