"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_extract, media, merge_dropout, packing, quality_rules, simhash, substring_dedup, token_counts, training_order, url_filters
from .common import table


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list made by rule from the hosts and urls that the pages have; the tables hold none."""
    number = lambda c: F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("int")
    hosts = pages.select(url_filters.host_of(F.col("url")).alias("h")).where("h <> ''").distinct().withColumn("n", number(F.col("h")))
    domains = hosts.select(F.substring_index("h", ".", -3).alias("h")).distinct().withColumn("n", number(F.concat(F.lit("domain:"), F.col("h"))))
    address = F.concat(url_filters.host_of(F.col("url")), url_filters.path_of(F.col("url")))
    query = url_filters.query_of(F.col("url"))
    urls = pages.select(address.alias("h")).distinct().withColumn("n", number(F.col("h")))
    asked = pages.where(query != "").select(F.concat(address, query).alias("h")).distinct().withColumn("n", number(F.col("h")))

    def entry(df: DataFrame, every: int, rest: int, scope: str, action: str, days: int, tail: str = "") -> DataFrame:
        listed = F.date_add(F.lit("2023-10-01").cast("date"), (F.col("n") % 256 + days).cast("int"))
        return df.where((F.col("n") % every) == rest).select(F.lit(scope).alias("scope"), F.concat("h", F.lit(tail)).alias("pattern"), F.lit(action).alias("action"), listed.alias("listed"))

    parts = [
        entry(hosts, 8, 0, "host", "block", 0),
        entry(hosts, 16, 0, "host", "remove", 60),
        entry(hosts, 32, 0, "host", "block", 120),
        entry(hosts, 32, 0, "host", "allow", 120),
        entry(hosts, 8, 1, "prefix", "block", 0, "/en"),
        entry(domains, 8, 2, "domain", "block", 30),
        entry(domains, 16, 2, "domain", "allow", 200),
        entry(urls, 64, 3, "url", "allow", 0),
        entry(urls, 64, 4, "url", "block", 90),
        entry(asked, 16, 5, "url", "allow", 0),
        entry(asked, 16, 6, "url", "block", 30),
    ]
    return reduce(DataFrame.unionByName, parts)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages have no fetch time: a page is taken as fetched page_id % 366 days after 2024-01-01."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int")))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    judged = url_filters.judge(captures, list_entries(pages))
    return judged.select("page_id", "url", "kept", *(text(c).alias(c) for c in ("fetched", "scope", "pattern", "listed")))


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INT) AS fetched,
    lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)', 1)) AS host,
    regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
    regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^?#]*(\?[^#]*)', 1) AS query
  FROM pages),
hosts AS (SELECT DISTINCT host AS h, CAST('0x' || substr(md5(host), 1, 4) AS INT) AS n FROM p WHERE host <> ''),
domains AS (SELECT DISTINCT array_to_string(list_slice(string_split(h, '.'), -3, -1), '.') AS h FROM hosts),
domain_n AS (SELECT h, CAST('0x' || substr(md5('domain:' || h), 1, 4) AS INT) AS n FROM domains),
urls AS (SELECT DISTINCT host || path AS h, CAST('0x' || substr(md5(host || path), 1, 4) AS INT) AS n FROM p),
asked AS (SELECT DISTINCT host || path || query AS h, CAST('0x' || substr(md5(host || path || query), 1, 4) AS INT) AS n FROM p WHERE query <> ''),
rules AS (
  SELECT 'host' AS scope, h AS pattern, 'block' AS action, n, 0 AS days FROM hosts WHERE n % 8 = 0
  UNION ALL SELECT 'host', h, 'remove', n, 60 FROM hosts WHERE n % 16 = 0
  UNION ALL SELECT 'host', h, 'block', n, 120 FROM hosts WHERE n % 32 = 0
  UNION ALL SELECT 'host', h, 'allow', n, 120 FROM hosts WHERE n % 32 = 0
  UNION ALL SELECT 'prefix', h || '/en', 'block', n, 0 FROM hosts WHERE n % 8 = 1
  UNION ALL SELECT 'domain', h, 'block', n, 30 FROM domain_n WHERE n % 8 = 2
  UNION ALL SELECT 'domain', h, 'allow', n, 200 FROM domain_n WHERE n % 16 = 2
  UNION ALL SELECT 'url', h, 'allow', n, 0 FROM urls WHERE n % 64 = 3
  UNION ALL SELECT 'url', h, 'block', n, 90 FROM urls WHERE n % 64 = 4
  UNION ALL SELECT 'url', h, 'allow', n, 0 FROM asked WHERE n % 16 = 5
  UNION ALL SELECT 'url', h, 'block', n, 30 FROM asked WHERE n % 16 = 6),
entries AS (
  SELECT scope, pattern, action, DATE '2023-10-01' + CAST(n % 256 + days AS INT) AS listed FROM rules),
latest AS (
  SELECT p.page_id, p.url, e.scope, e.pattern, e.action, e.listed,
    row_number() OVER (PARTITION BY p.page_id, p.url, e.scope, e.pattern
      ORDER BY e.listed DESC, CASE e.action WHEN 'block' THEN 2 WHEN 'allow' THEN 1 ELSE 0 END DESC) AS r
  FROM p JOIN entries e ON e.listed <= p.fetched AND CASE e.scope
    WHEN 'host' THEN e.pattern = p.host
    WHEN 'url' THEN e.pattern = p.host || p.path OR e.pattern = p.host || p.path || p.query
    WHEN 'domain' THEN p.host = e.pattern OR ends_with(p.host, '.' || e.pattern)
    ELSE p.host || p.path = e.pattern OR starts_with(p.host || p.path, e.pattern || '/') END),
best AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, url
    ORDER BY CASE scope WHEN 'url' THEN 4 WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(pattern) DESC) AS k
  FROM latest WHERE r = 1 AND action <> 'remove')
SELECT p.page_id, p.url, strftime(p.fetched, '%Y-%m-%d') AS fetched, coalesce(b.action, 'allow') <> 'block' AS kept,
  coalesce(b.scope, '') AS scope, coalesce(b.pattern, '') AS pattern, coalesce(strftime(b.listed, '%Y-%m-%d'), '') AS listed
FROM p LEFT JOIN best b ON b.page_id = p.page_id AND b.url = p.url AND b.k = 1
"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(table(spark, sf_dir, "documents"))


def op10_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.encode_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": op1_url_filters,
        "op2_token_counts": op2_token_counts,
        "op3_quality_rules": op3_quality_rules,
        "op4_packing": op4_packing,
        "op5_simhash": op5_simhash,
        "op6_training_order": op6_training_order,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_html_extraction": op8_html_extraction,
        "op9_media_columns": op9_media_columns,
        "op10_merge_dropout": op10_merge_dropout,
    }


OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, lang, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams), (SELECT unnest(generate_series(0, 4)) AS k)
  WHERE c > 1 GROUP BY doc_id),
f AS (
  SELECT w.doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, len(ls) AS n_lines
  FROM w LEFT JOIN covered c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
m AS (
  SELECT *, CASE WHEN word_chars > 0 THEN n_symbols * 10000 // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 10000 // n_lines ELSE 0 END AS dup_lines FROM b),
v AS (
  SELECT lang, source, 'symbols' AS metric, symbols AS v FROM m WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'word_length', word_length FROM m WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'dup_lines', dup_lines FROM m WHERE NOT base_failed),
low AS (SELECT *, CASE WHEN v < 128 THEN v ELSE v // (1 << (length(bin(v)) - 7)) * (1 << (length(bin(v)) - 7)) END AS low FROM v),
levels AS (
  SELECT 0 AS level, lang AS kl, source AS ks, metric, low FROM low
  UNION ALL SELECT 1, lang, '', metric, low FROM low UNION ALL SELECT 2, '', '', metric, low FROM low),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY level, kl, ks, metric ORDER BY low) AS r, count(*) OVER (PARTITION BY level, kl, ks, metric) AS n FROM levels),
q AS (
  SELECT level, kl, ks, metric, n, min(CASE WHEN r * 100 >= n * 25 THEN low END) AS q25, min(CASE WHEN r * 100 >= n * 75 THEN low END) AS q75
  FROM ranked GROUP BY ALL),
fence AS (SELECT level, kl, ks, metric, n, greatest(0, 64 * q25 - 96 * (q75 - q25)) AS lo, 64 * q75 + 96 * (q75 - q25) AS hi FROM q),
language AS (
  SELECT l.kl, metric, (l.n * l.lo + 50 * a.lo) // (l.n + 50) AS lo, (l.n * l.hi + 50 * a.hi) // (l.n + 50) AS hi
  FROM fence l JOIN fence a USING (metric) WHERE l.level = 1 AND a.level = 2),
chosen AS (
  SELECT g.kl AS lang, g.ks AS source, metric, (g.n * g.lo + 50 * l.lo) // (g.n + 50) AS lo, (g.n * g.hi + 50 * l.hi) // (g.n + 50) AS hi
  FROM fence g JOIN language l USING (kl, metric) WHERE g.level = 0),
outside AS (
  SELECT m.doc_id, count(*) AS n FROM m JOIN chosen c USING (lang, source)
  WHERE 64 * CASE metric WHEN 'symbols' THEN m.symbols WHEN 'word_length' THEN m.word_length ELSE m.dup_lines END NOT BETWEEN lo AND hi
  GROUP BY m.doc_id HAVING count(*) >= 2)
SELECT m.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND o.n IS NULL AS kept
FROM m LEFT JOIN outside o ON o.doc_id = m.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """Token counts, ids, fingerprints, chunks, images and trees have no SQL form; the tests hold those against brute force."""
    return {"op1_url_filters": OP1_SQL, "op3_quality_rules": OP3_SQL}
