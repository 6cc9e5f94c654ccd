"""The registered corpus queries, each over its whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, decontaminate, embedding_dedup, embedding_whitening, line_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, suffix_dedup, token_counts, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item in it."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=3, num=90)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many went as boilerplate, and the SHA-256 of what is left."""
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return embedding_dedup.near_duplicates(rows).select("vec_id", "n_links", "component_id", "kept")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit(table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return embedding_whitening.component_rows(rows, embedding_whitening.fit(rows))


#: Words, lines with a word and 3-word windows by list functions; the verdict repeats the rules' integer tests.
OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
s AS (SELECT *, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM t),
r AS (SELECT doc_id, g, unnest(g) AS x, generate_subscripts(g, 1) AS i FROM s),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM r),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM d, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
c AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '\p{Lu}.*\p{Lu}') AND NOT regexp_matches(x, '\p{Ll}'))) AS n_caps
  FROM s LEFT JOIN p USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 100 * n_caps > 30 * n_words) AS kept
FROM c"""

OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
b AS (SELECT key, min((doc_id, pos)) AS first FROM t WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT site) >= 10),
g AS (SELECT t.doc_id, t.pos, t.line, b.key IS NOT NULL AND (t.doc_id, t.pos) IS DISTINCT FROM b.first AS gone FROM t LEFT JOIN b USING (key))
SELECT doc_id, count(*) AS n_lines, (count(*) FILTER (gone)) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL"""

#: Base32: each 10 hex digits of the SHA-1 are 40 bits, 8 digits of 5. The record is written out as it stands in a .warc file.
OP6_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, md5('page:' || page_id) AS m FROM pages),
d AS (
  SELECT *, sha1(html) AS h, octet_length(encode(html))::BIGINT AS size, min(page_id) OVER (PARTITION BY html) AS first, chr(13) || chr(10) AS nl,
         first_value(url) OVER (PARTITION BY html ORDER BY page_id) AS first_url,
         '<urn:uuid:' || concat_ws('-', m[1:8], m[9:12], m[13:16], m[17:20], m[21:32]) || '>' AS rid,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(sha1(html), (i // 8 * 10 + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31) + 1)::INT, 1)), '') AS digest FROM p),
r AS (
  SELECT *, page_id = first AS own, md5('page:' || first) AS fm,
         'HTTP/1.1 200 OK' || nl || 'Content-Type: text/html; charset=utf-8' || nl || 'Content-Length: ' || size || nl || nl AS http FROM d)
SELECT page_id, size AS payload_bytes, digest AS payload_digest, CASE WHEN own THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN own THEN NULL ELSE first END AS refers_to,
       sha256(concat_ws(nl, 'WARC/1.1', 'WARC-Type: ' || CASE WHEN own THEN 'response' ELSE 'revisit' END, 'WARC-Record-ID: ' || rid, 'WARC-Date: 2024-01-01T00:00:00Z', 'WARC-Target-URI: ' || url,
         'WARC-Payload-Digest: sha1:' || digest, 'Page-ID: ' || page_id,
         CASE WHEN NOT own THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || nl || 'WARC-Refers-To: <urn:uuid:' || concat_ws('-', fm[1:8], fm[9:12], fm[13:16], fm[17:20], fm[21:32])
           || '>' || nl || 'WARC-Refers-To-Target-URI: ' || first_url END,
         'Content-Type: application/http; msgtype=response', 'Content-Length: ' || octet_length(encode(http)) + CASE WHEN own THEN size ELSE 0 END)
       || nl || nl || http || CASE WHEN own THEN html ELSE '' END || nl || nl) AS record_sha256
FROM r"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_ngram_join, op4_suffix_dedup, op5_line_dedup, op6_warc, op7_packing, op8_quality_classifier, op9_pii, op10_quality_rules, op11_embedding_dedup, op12_conversation_repair, op13_embedding_whitening)}
ORACLES: dict[str, str] = {"op5_line_dedup": OP5_SQL, "op6_warc": OP6_SQL, "op10_quality_rules": OP10_SQL}
