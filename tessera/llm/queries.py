"""The thin queries of the contract, one for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, langid, licenses, pieces, quality, secrets, simhash, topk, urls
from tessera.llm.rows import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.listing(spark))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.components(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, vectors.where(F.col("id") % 100 == 0))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predicted(table(spark, sf_dir, "documents"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_secret_scans,
        op3_decontamination,
        op4_byte_bpe,
        op5_topk_search,
        op6_simhash,
        op7_quality,
        op8_token_counts,
        op9_language_id,
        op10_license_scans,
    )
}

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _values(rows) -> str:
    quoted = lambda x: "'" + str(x).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)


_OP1 = rf"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (SELECT * FROM (VALUES {_values(urls.RULES)}) t(verdict, h, p)),
fit AS (
  SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(r.verdict, length(h || p)) AS verdict
  FROM u JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid),
site AS (
  SELECT DISTINCT rid FROM u JOIN (VALUES {_values([(x.split("/")[2],) for x in urls.LISTED])}) s(h) ON host = h OR ends_with(host, '.' || h))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN site.rid IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM u LEFT JOIN fit USING (rid) LEFT JOIN site USING (rid)
"""

_OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("text")} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT item, w, least({decontam.WINDOW}, len(w)) AS n FROM i WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS k
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM s)),
dw AS (
  SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT rid, item, p, n FROM dw JOIN iw USING (n, k)),
hits AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM m) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN its USING (rid)
"""

_OP5 = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id AS id, list_transform(embedding, lambda x: floor({topk.SCALE} * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid, q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 100 = 0 AND q.rid <> c.rid)
SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {topk.K}
"""

_OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS w FROM documents),
p AS (SELECT string_split(phrase, ' ') AS pw, label FROM (VALUES {_values(licenses.PHRASES)}) t(phrase, label)),
b AS (SELECT rid, pos - 1 AS pos, label FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS pos FROM d), p WHERE w[pos:pos + len(pw) - 1] = pw),
base AS (SELECT rid, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM b GROUP BY rid),
t AS (SELECT label, list_distinct({_WORDS.format("body")}) AS tw FROM (VALUES {_values(licenses.TEMPLATES)}) t(label, body)),
lines AS (SELECT rid, list_distinct({_WORDS.format("line")}) AS lw FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)),
m AS (SELECT rid, label, len(list_intersect(tw, lw)) / len(tw) AS part FROM lines, t WHERE len(list_intersect(tw, lw)) >= ceil(round({licenses.THRESHOLD} * len(tw), 9))),
every_label AS (SELECT DISTINCT rid, label FROM (SELECT rid, label FROM b UNION ALL SELECT rid, label FROM m)),
named AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM every_label GROUP BY rid),
named_base AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT rid, label FROM b) GROUP BY rid),
best AS (SELECT rid, max(part) AS part FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(named_base.labels, '') AS base_labels, coalesce(named.labels, '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN named USING (rid) LEFT JOIN named_base USING (rid) LEFT JOIN best USING (rid)
"""

#: The others hash with XXH64, tokenize, fit models or need code-point positions: tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op1_url_filters": _OP1, "op3_decontamination": _OP3, "op5_topk_search": _OP5, "op10_license_scans": _OP10}
