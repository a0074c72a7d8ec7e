"""The registered queries: each operator over its whole table with its production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    fingerprint,
    jaccard_join,
    language_id,
    licenses,
    near_dedup,
    packing,
    pii,
    quality,
    resampling,
    spelling,
    substring_dedup,
    suffix_dedup,
)
from .common import documents


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return quality.with_verdict(docs.select("doc_id", "text"), model).drop("text")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.fit(docs)).withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edits(documents(spark, sf_dir))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    return bpe.digests(bpe.encode(documents(spark, sf_dir), path), path)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.predict(docs, language_id.fit(docs))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document's text."""
    return substring_dedup.cut_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_removed", "n_spans", "n_chars", "text")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(documents(spark, sf_dir), packing.text_cluster(F.col("text")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir), benchmark).select("doc_id", "n_features", "weight", "score", "rank")


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(documents(spark, sf_dir))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_fingerprints": op5_fingerprints,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
    "op13_spelling_variants": op13_spelling_variants,
}
