"""The queries of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clinflow.llm import bpe, contamination, divergence, exact_dedup, language, licenses, near_dedup, periodic_runs, pii, quality, secrets, sharding, warc
from clinflow.llm.common import scratch, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_spans(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


NUMBERED = (op1_decontamination, op2_quality, op3_licenses, op4_secrets, op5_near_dedup, op6_byte_bpe, op7_warc, op8_pii, op9_exact_dedup, op10_sharding, op11_source_divergence, op12_language_id, op13_periodic_runs)
QUERIES = {f.__name__: f for f in NUMBERED}
ORACLES = {
    "op1_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i + 1:i + n], ' ') AS w
               FROM (SELECT *, least(len(ws), 13) AS n FROM b WHERE len(ws) > 0), unnest(range(0, len(ws) - n + 1)) AS u(i)),
        dw AS (SELECT doc_id, i, n, array_to_string(ws[i + 1:i + n], ' ') AS w
               FROM d, (SELECT DISTINCT n FROM bw), unnest(range(0, greatest(len(ws) - n + 1, 0))) AS u(i)),
        h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (w, n)),
        p AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM h), unnest(range(0, n)) AS u(j) GROUP BY doc_id),
        q AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(item, ',' ORDER BY item) AS items
              FROM (SELECT DISTINCT doc_id, item_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN q USING (doc_id)""",
    "op5_near_dedup": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
          s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS g FROM d, unnest(range(1, greatest(len(ws), 2))) AS u(i) WHERE len(ws) > 0),
          n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
          c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
          l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
          e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
          r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT a, y FROM r JOIN e ON b = x)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.id AS component_id, d.doc_id = c.id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS id FROM r GROUP BY 1) c USING (doc_id)""",
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
          g AS (SELECT DISTINCT lang, source FROM d),
          t AS (SELECT id, lang, source, term FROM d, unnest(ws) AS u(term)),
          k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
          a AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM k GROUP BY 1),
          c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
          s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
          f AS (SELECT g.lang, g.source, term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(s.total, 0) + 2 * a.v))::BIGINT AS p,
                       (1 + 1000000000::HUGEINT * (k.n + 2) // (a.total + 2 * a.v))::BIGINT AS q
                FROM g JOIN k USING (lang) JOIN a USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN s USING (lang, source)),
          x AS (SELECT l.lang, l.source, r.source AS item, sum((l.p - r.p) * (l.p - r.p) // (l.p + r.p)) AS value FROM f l JOIN f r ON l.lang = r.lang AND l.term = r.term AND l.source <> r.source GROUP BY ALL),
          y AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0)::BIGINT AS value
                FROM g JOIN (SELECT lang, source FROM g) o USING (lang) LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = o.source WHERE g.source <> o.source
                UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM f WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM y)
        WHERE part = 'pair' OR rank <= 10""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
             b AS (SELECT *, unhex(sha1(body))::BIT::VARCHAR AS bits FROM p)
        SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (1 + list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr(bits, (5 * i + j + 1)::BIGINT, 1) = '1' THEN 1 << (4 - j)::INT ELSE 0 END)))::BIGINT, 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM b""",
}
