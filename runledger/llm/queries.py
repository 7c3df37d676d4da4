"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from runledger.llm import (
    block_naming, bm25_packing, bpe_count, count_tree, importance,
    prefix_trie, quote_links, secret_scan, spaced_seeds, style_tree,
    suffix_names, toxic_mil, weak_quality)
from runledger.llm.common import documents, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base patterns and random tokens in whole texts."""
    return secret_scan.scan(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from rows that are not held out."""
    scored = toxic_mil.toxicity(documents(spark, sf_dir),
                                table(spark, sf_dir, "labels"))
    spans = F.transform("offending", lambda s: F.concat_ws(
        ":", s["start"], s["end"]))
    return (scored.withColumn("n_offending", F.size("offending"))
            .withColumn("offending", F.array_join(spans, ",")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of whole texts, by block naming."""
    return block_naming.exact_duplicates(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by repeated 200-byte strings, removed."""
    return suffix_names.remove_repeats(
        documents(spark, sf_dir), file_scan=True).drop("kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages, with the passage."""
    return spaced_seeds.leaks(documents(spark, sf_dir),
                              table(spark, sf_dir, "benchmark"))


def op6_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, linked by quotations and freed of them."""
    return quote_links.conversations(table(spark, sf_dir, "conversations"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    return bm25_packing.pack(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, from weak labels."""
    return weak_quality.quality(documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of whole texts by heap merging."""
    return bpe_count.token_counts(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under the 4-word Jaccard join at 0.85."""
    return count_tree.near_duplicates(documents(spark, sf_dir))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the style trees of the hosts."""
    return style_tree.main_text(table(spark, sf_dir, "pages"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, scores and ranks of the draw towards the benchmark."""
    return importance.ranked(documents(spark, sf_dir), table(
        spark, sf_dir, "benchmark")).drop("key")


QUERIES: dict[str, QueryFn] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_quote_links": op6_quote_links,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_html_extraction": op11_html_extraction,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       CAST(count(*) OVER same AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op4_suffix_dedup": """
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, '')))
    AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n
  FROM documents),
strings AS (
  SELECT r, pos, md5(substr(h, 2 * pos + 1, 400)) AS s
  FROM (SELECT r, h, unnest(range(0, n - 199)) AS pos FROM docs
        WHERE n >= 200)),
again AS (
  SELECT r, pos FROM strings SEMI JOIN (
    SELECT s FROM strings GROUP BY s HAVING count(*) > 1) USING (s)),
marked AS (
  SELECT r, pos, coalesce(pos > lag(pos) OVER w + 200, true) AS is_new
  FROM again WINDOW w AS (PARTITION BY r ORDER BY pos)),
numbered AS (
  SELECT r, pos, count(*) FILTER (is_new) OVER (PARTITION BY r ORDER BY pos)
    AS run FROM marked),
runs AS (SELECT r, min(pos) AS a, max(pos) + 200 AS b
         FROM numbered GROUP BY r, run),
pieces AS (
  SELECT r, a, b - a AS n, substr(h, 2 * before + 1, 2 * (a - before)) AS p
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0)
          AS before FROM runs) JOIN docs USING (r)),
cut AS (SELECT r, string_agg(p, '' ORDER BY a) AS p, count(*) AS k,
               sum(n) AS removed FROM pieces GROUP BY r),
ends AS (SELECT r, max(b) AS b FROM runs GROUP BY r)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT)
         AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(p, '') || substr(h, 2 * coalesce(b, 0) + 1)))
         AS kept_sha256
FROM docs LEFT JOIN cut USING (r) LEFT JOIN ends USING (r)
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) BETWEEN 1 AND 3
    THEN [array_to_string(w, ' ')] ELSE list_transform(
      range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)
    AS s
  FROM words),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS k
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.r < b.r
  GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM shared JOIN sizes AS x ON x.r = a
  JOIN sizes AS y ON y.r = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT r, r AS m FROM words
  UNION SELECT reached.r, b FROM reached JOIN both_ways ON a = m)
SELECT words.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       min(other.doc_id) AS component_id
FROM words JOIN reached USING (r) JOIN words AS other ON other.r = m
LEFT JOIN sizes ON sizes.r = words.r
GROUP BY words.r, words.doc_id, n
""",
    "op12_prefix_trie": """
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i:
      CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) AS t(b))),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(coalesce(role, '') || chr(0) || coalesce(text, '')))
           AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(
      range(1, length(CAST(c AS VARCHAR)) + 1),
      lambda i: CAST(unicode(substr(CAST(c AS VARCHAR), CAST(i AS INT), 1))
        AS BIGINT))),
    lambda a, b: xor(a // 256, crcs[CAST(xor(a, b) % 256 AS INT) + 1])),
    4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), crc_table),
kept AS (
  SELECT convs.c, 0 AS part, place, role, text
  FROM convs JOIN turns ON turns.c = base AND place <= h
  UNION ALL
  SELECT c, 1, place, role, text FROM convs JOIN turns USING (c)
  WHERE place > h),
rebuilt AS (
  SELECT c, row_number() OVER w AS d, length(text) AS chars,
         list(sha256(role || chr(0) || text)) OVER w AS path
  FROM kept WINDOW w AS (PARTITION BY c ORDER BY part, place)),
steps AS (
  SELECT c, CAST(d AS BIGINT) AS d, chars,
         sha256(array_to_string(path, ',')) AS name FROM rebuilt
  UNION ALL SELECT c, 0, 0, 'root' FROM convs),
linked AS (
  SELECT *, lag(name) OVER (PARTITION BY c ORDER BY d) AS up,
         lead(name) OVER (PARTITION BY c ORDER BY d) IS NULL AS is_end
  FROM steps),
nodes AS (
  SELECT name, min(c) AS c, min(d) AS d, min(up) AS up, count(*) AS n,
         (count(*) - 1) * min(chars) AS saved,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)
           FILTER (is_end), '') AS ends
  FROM linked GROUP BY name),
children AS (SELECT up AS name, count(*) AS k FROM nodes GROUP BY up),
whole AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes
          LEFT JOIN children USING (name)),
sums AS (
  SELECT steps.name, count(*) FILTER (k = 0) AS leaves, sum(saved) AS saved
  FROM whole JOIN steps ON steps.c = whole.c AND steps.d <= whole.d
  GROUP BY steps.name)
SELECT whole.c AS conv_id, whole.d AS depth, above.c AS parent_conv_id,
       CAST(whole.n AS BIGINT) AS n_convs, CAST(whole.k AS BIGINT)
         AS n_children, CAST(sums.leaves AS BIGINT) AS n_leaves,
       CAST(sums.saved AS BIGINT) AS saved_tokens,
       sha256(whole.ends) AS ends_sha256
FROM whole JOIN sums USING (name)
LEFT JOIN nodes AS above ON above.name = whole.up
""",
    "op13_importance_resampling": """
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS crcs FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i:
      CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) AS t(b))),
texts AS (
  SELECT true AS own, doc_id, text, row_number() OVER () AS r FROM documents
  UNION ALL SELECT false, NULL, text, row_number() OVER () FROM benchmark),
words AS (
  SELECT own, r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT own, r, f, count(*) AS k FROM (
    SELECT own, r, unnest(w) AS f FROM words UNION ALL
    SELECT own, r, unnest(list_transform(range(1, len(w)), lambda i:
      w[CAST(i AS INT)] || ' ' || w[CAST(i + 1 AS INT)])) FROM words)
  GROUP BY ALL),
coded AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(0, octet_length(encode(f))), lambda i:
        CAST('0x' || hex(encode(f))[CAST(2 * i + 1 AS INT)
          : CAST(2 * i + 2 AS INT)] AS BIGINT))),
    lambda a, b: xor(a // 256, crcs[CAST(xor(a, b) % 256 AS INT) + 1])),
    4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), crc_table),
hashed AS (SELECT own, r, bucket, k FROM features JOIN coded USING (f)),
totals AS (
  SELECT bucket, coalesce(sum(k) FILTER (own), 0) AS s,
         coalesce(sum(k) FILTER (NOT own), 0) AS t
  FROM hashed GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000)
    AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM totals, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM totals)),
weights AS (
  SELECT r, CAST(sum(k) AS BIGINT) AS n, CAST(floor(CAST(sum(k * g)
    AS DOUBLE) / CAST(sum(k) AS DOUBLE)) AS BIGINT) AS weight
  FROM hashed JOIN gains USING (bucket) WHERE own GROUP BY r),
scores AS (
  SELECT doc_id, len(w) >= 20 AS able, coalesce(n, 0) AS n_features,
         coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(
           -1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8)
             AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT)
           AS score
  FROM words LEFT JOIN weights USING (r) WHERE own),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id)
    AS place, count(*) OVER (PARTITION BY able) AS able_n FROM scores)
SELECT doc_id, n_features, weight, score,
       CASE WHEN able AND place <= able_n * 25 // 100 THEN place END AS rank
FROM ranked
""",
}
