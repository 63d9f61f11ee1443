"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpack.llm import (
    align,
    bestfit,
    bpe,
    decontam,
    html,
    packing,
    quality,
    secrets,
    simhash,
    substring,
    toxicity,
    urls,
    variants,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: One in so many runs of letters loses a letter before spellings are grouped.
LOST_LETTER_EVERY = 199
#: Verdict, host and path of each rule of the URL query.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.deduplicate(table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secrets.scan(docs, secrets.learn(docs))

    def n(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = secrets.joined("found", secrets.KINDS)
    return found.select("doc_id", *map(n, secrets.KINDS), F.sha2(F.encode(base, "utf-8"), 256).alias("base_sha256"),
                        secrets.joined("found", (*secrets.KINDS, secrets.FORMAT)).alias("spans"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         F.size("sentences").alias("n_sentences"))


def op4_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), TOKENIZER)


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    return packing.round_trip(table(spark, folder, "documents"), TOKENIZER)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return bestfit.pack(table(spark, folder, "documents"), TOKENIZER)


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(table(spark, folder, "documents"), TOKENIZER, PIECE_MODEL)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    found = variants.with_lost_letters(variants.runs(table(spark, folder, "documents")), LOST_LETTER_EVERY)
    return variants.group(variants.word_counts(found))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_substring_dedup, op2_secret_scan, op3_toxicity, op4_bpe_round_trip, op5_url_filter, op6_simhash,
             op7_packed_ids, op8_decontamination, op9_quality, op10_html_text, op11_best_fit_packing,
             op12_tokenizer_alignment, op13_spelling_variants, pipeline)
    return {f.__name__: f for f in named}


SUBSTRING_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words)),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM windows JOIN firsts USING (h) WHERE first < doc_id),
marks AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
numbered AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT n.doc_id, string_agg(n.w[n.i], ' ' ORDER BY n.i) AS k FROM numbered n
  ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.i = g.i GROUP BY n.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN marks USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

URL_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM rest),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p) * 1000 + length(h)) AS rule, arg_max(verdict, length(h || p) * 1000 + length(h)) AS verdict
  FROM split JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN fits USING (page_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": SUBSTRING_SQL, "op5_url_filter": URL_SQL}
