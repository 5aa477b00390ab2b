"""The registered queries of the operators, with production parameters over
whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billetic.llm import (
    bpe,
    crf,
    decontamination,
    embeddings,
    extraction,
    mixing,
    repeats,
    runs,
    secrets,
    sharding,
    simhash,
    variants,
    warc,
)
from billetic.llm._common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(table(spark, sf_dir, "documents"), n_shards=24)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.identify(table(spark, sf_dir, "documents"))


def _with_cycles(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: in one document of ten, as its id says, the words
    from a place on repeat a period."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = docs.select("doc_id", "text", crc.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    cut = cut.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)}).withColumn(
        "a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int"))).withColumn(
        "p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    unit = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    whole = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(unit), F.lit(1), rest))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_with_cycles(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.withColumn("best", runs.strongest("runs")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(table(spark, sf_dir, "documents"))
    return variants.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_warc": op3_warc,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_mixing": op5_mixing,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_sharding": op7_sharding,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE: dict[str, str] = {
    "op3_warc": r"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html, url, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
judged AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS first FROM rows)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, url
FROM judged
""",
    "op5_mixing": mixing.ORACLE,
}
