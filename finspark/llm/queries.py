"""The registered queries of the corpus operators: each applies its operator,
with production parameters, to the whole of its table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, license, minhash, oracle, packing, prefixes, ranked, rules, sharding, substring, suffix, tagpaths,
               toxicity, warc)
from .common import fold_of, read_table, stored


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; FINSPARK_TOKENIZERS names another folder."""
    if folder := os.environ.get("FINSPARK_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(rules.statistics(read_table(spark, sf_dir, "documents")), "statistics")
    learned = rules.learn(stats, read_table(spark, sf_dir, "labels"))
    return rules.apply_rules(stats, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> toxicity.Model:
    """Fitted on the labels whose fold is not 0."""
    docs = read_table(spark, sf_dir, "documents") if docs is None else docs
    return toxicity.fit(docs, read_table(spark, sf_dir, "labels"), usable=fold_of(F.col("doc_id")) != 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    score = toxicity.score_column(toxicity_model(spark, sf_dir), F.col("text"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                       score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleave(read_table(spark, sf_dir, "documents"), shards=40, seed=17)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), wanted_pieces=64)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(read_table(spark, sf_dir, "documents"), license.NOTICES | license.license_texts(), passages=True)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpaths.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(prefixes.shared_heads(prefixes.turn_paths(read_table(spark, sf_dir, "conversations")), every=20, most=4))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_warc": op2_warc,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_license_scan": op9_license_scan,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_html_extraction": op11_html_extraction,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE = {
    "op1_substring_dedup": oracle.OP1,
    "op2_warc": oracle.OP2,
    "op3_benchmark_decontamination": oracle.OP3,
    "op7_suffix_array_dedup": oracle.OP7,
    "op9_license_scan": oracle.op9(license.NOTICES, 0.8),
    "op10_minhash_near_dedup": oracle.OP10,
    "op12_ranked_search": oracle.OP12,
    "op13_prefix_trie": oracle.OP13,
}
