"""Registered queries of the training-data operators: each applies its operator, with production
parameters, to its whole table and derives the contracted columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macroseries.llm import (align, crossent, decontam, kdshard, langid, minhash, packing, quality,
                             rules, template, tokenstore, warc, whitening)
from macroseries.llm.common import crc_mod3, table
from macroseries.session import scratch_path


def held_out():
    """True for rows no label may be learnt from (a NULL id is never held out, nor learnt from)."""
    return F.coalesce(crc_mod3("doc_id") == 1, F.lit(False)).alias("held_out")


def learnable(df: DataFrame) -> DataFrame:
    return df.filter(crc_mod3("doc_id") != 1)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_back(spark, path).select("page_id", "payload_bytes", "payload_digest",
                                              "record_type", "refers_to")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark")).drop("text_hash")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.vocabulary_path())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = rules.decide(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "rule")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = kdshard.shard(table(spark, sf_dir, "documents"), shards=16)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return crossent.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_text(table(spark, sf_dir, "pages")).drop("n_slots")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(learnable(docs))
    got = docs.select("doc_id", held_out(), langid.predict(docs, model).alias("p"))
    return got.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit(docs, learnable(table(spark, sf_dir, "labels")))
    got = docs.select("doc_id", held_out(), quality.score(docs, weights).alias("score"))
    return got.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2).drop("text_hash")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), *align.vocabulary_paths())


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenstore.write_tokens(table(spark, sf_dir, "documents"), path, packing.vocabulary_path())
    return tokenstore.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_sharding": op5_sharding,
    "op6_cross_entropy": op6_cross_entropy,
    "op7_main_text": op7_main_text,
    "op8_language_id": op8_language_id,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_token_files": op13_token_files,
}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(h, {1 + 10 * k}, 10))"
    f"::BIGINT >> {5 * (7 - j)}) & 31 AS INTEGER), 1)" for k in range(4) for j in range(8))

ORACLES: dict[str, str] = {
    "op1_warc": f"""
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha1(coalesce(html, '')) AS h FROM pages),
             d AS (SELECT h, max(page_id) AS first FROM p GROUP BY h)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN d USING (h)""",
}
