"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dated_lists(pages: DataFrame) -> DataFrame:
    """List entries for the hosts of the pages, dated by a hash of their names."""
    from folioscope.llm.url_lists import host_of

    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    draw = lambda c: F.conv(F.substring(F.md5(F.col(c).cast("binary")), 1, 4), 16, 10).cast("int")
    hosts = hosts.withColumn("x", draw("host"))
    domains = hosts.select(F.regexp_extract("host", r"[^.]+\.[^.]+$", 0).alias("domain")).where("domain <> ''").distinct().withColumn("x", draw("domain"))
    day = lambda c: F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + c * 86400)
    x = F.col("x")

    def edits(rows: DataFrame, name: str, effect: str, scope: str, key, dated: list) -> DataFrame:
        acts = F.array(*[F.struct(F.lit(a).alias("action"), day(d).alias("at")) for a, d in dated])
        return rows.select(F.lit(name).alias("list"), F.lit(effect).alias("effect"), F.lit(scope).alias("scope"), key.alias("key"), F.explode(acts).alias("e")).select("list", "effect", "scope", "key", "e.*")

    spam = edits(hosts.where("x % 4 = 0"), "spam", "block", "host", F.col("host"), [("add", x % 300), ("remove", x % 300 + 60), ("add", x % 300 + 120)])
    adult = edits(domains.where("x % 3 = 0"), "adult", "block", "domain", F.col("domain"), [("add", x % 200)])
    news = edits(hosts.where("x % 5 = 0"), "news", "allow", "folder", F.concat("host", F.lit("/en/")), [("add", x % 250), ("remove", x % 250 + 90)])
    return spam.unionByName(adult).unionByName(news)


def op1_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.url_lists import evaluated

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.pmod(F.col("page_id") * 7919, F.lit(8760)) * 3600)
    found = evaluated(pages.withColumn("fetched_at", fetched), dated_lists(pages))
    return found.select("page_id", "verdict", "list", "scope", "matched_key", F.unix_seconds("since").alias("since"))


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, url, page_id * 7919 % 8760 * 3600 AS t,
         regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '\.$', ''), '^www\.', '') AS host,
         regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
h AS (SELECT host, CAST('0x' || substr(md5(host), 1, 4) AS INT) AS x FROM (SELECT DISTINCT host FROM p WHERE host <> '')),
d AS (SELECT domain, CAST('0x' || substr(md5(domain), 1, 4) AS INT) AS x
      FROM (SELECT DISTINCT regexp_extract(host, '[^.]+\.[^.]+$', 0) AS domain FROM h) WHERE domain <> ''),
i AS (
  SELECT 'spam' AS list, 'block' AS effect, 'host' AS scope, host AS key, x % 300 * 86400 AS since, (x % 300 + 60) * 86400 AS until FROM h WHERE x % 4 = 0
  UNION ALL SELECT 'spam', 'block', 'host', host, (x % 300 + 120) * 86400, NULL FROM h WHERE x % 4 = 0
  UNION ALL SELECT 'adult', 'block', 'domain', domain, x % 200 * 86400, NULL FROM d WHERE x % 3 = 0
  UNION ALL SELECT 'news', 'allow', 'folder', host || '/en/', x % 250 * 86400, (x % 250 + 90) * 86400 FROM h WHERE x % 5 = 0),
m AS (
  SELECT p.page_id, i.*, row_number() OVER (PARTITION BY p.page_id ORDER BY
           CASE i.scope WHEN 'folder' THEN 1 WHEN 'host' THEN 2 ELSE 3 END, length(i.key) DESC, i.effect, i.list) AS rn
  FROM p JOIN i ON p.host <> '' AND p.t >= i.since AND (i.until IS NULL OR p.t < i.until) AND (
    i.scope = 'host' AND p.host = i.key
    OR i.scope = 'domain' AND (p.host = i.key OR ends_with(p.host, '.' || i.key))
    OR i.scope = 'folder' AND starts_with(p.host || p.path || '/', i.key)))
SELECT p.page_id, coalesce(m.effect, 'none') AS verdict, m.list, m.scope, m.key AS matched_key, CAST(m.since + 1704067200 AS BIGINT) AS since
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.rn = 1
"""


def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.simhash_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.suffix_dedup import digests

    return digests(table(spark, sf_dir, "documents"))


def op4_license_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.license_scan import families

    return families(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.quality_rules import quality

    judged = quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_pii_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm import pii

    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    return found.select("doc_id", *(f"n_{k}" for k in pii.BASE), F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_spans", "doubted")


def op7_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.secrets import report

    return report(table(spark, sf_dir, "documents"))


def op8_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    from folioscope.llm.decontaminate import contamination

    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm import language_id

    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    return language_id.predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from folioscope.llm import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm import whitening

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whitened(vectors, whitening.fit(vectors))


def repeated_from(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of every tenth document by its hash, made periodic from some word on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.periodic_runs import collapsed

    found = collapsed(table(spark, sf_dir, "documents").select("doc_id", "text"), prepare=repeated_from, texts=False)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from folioscope.llm.site_tree import extracted

    return extracted(table(spark, sf_dir, "pages"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_temporal_url_lists, op2_simhash_pivots, op3_bwt_merge, op4_license_classifier, op5_risk_controlled_quality, op6_pii_weak_labels, op7_entropy_secrets, op8_simhash_windows, op9_language_id, op10_byte_bpe, op11_embedding_whitening, op12_periodic_runs, op13_site_style_tree)}


def oracle_sql() -> dict[str, str]:
    return {"op1_temporal_url_lists": OP1_SQL}
