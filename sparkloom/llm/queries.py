"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, langid, licences, line_rules, mixing, oracles, pigeonhole, recompress, simhash, spelling, suffixes, whitening

RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *licences.RESULTS)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return recompress.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    path = ranks_path or public_tokenizers.path(RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN)
    return back.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_rules.quality_rules(docs).select("doc_id", *line_rules.RESULTS, "n_removed_lines", F.md5(F.col(line_rules.CLEAN_TEXT).cast("binary")).alias("clean_md5"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "source", *mixing.RESULTS)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.createDataFrame([(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.format_chat(chat.records(rows)))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.filter(F.pmod("vec_id", F.lit(20)) == 0))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.is_held_out(F.col("doc_id")))
    model = langid.fit(docs.filter("NOT held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pigeonhole.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")).select("vec_id", *pigeonhole.RESULTS)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_substring_dedup, op3_byte_bpe, op4_simhash_dedup, op5_suffix_dedup, op6_quality_rules, op7_source_mixing, op8_chat_format, op9_nearest_neighbours, op10_language_id, op11_embedding_whitening, op12_embedding_dedup, op13_spelling_variants)}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
