"""The queries of the subpackage: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontamination, fill_in_middle, language_model, licenses, near_dedup, oracles, packing, pii, quality_rules, secrets, simhash, substring_dedup, tokens, whitening


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(_table(spark, sf_dir))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(_table(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(_table(spark, sf_dir))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_families(_table(spark, sf_dir))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.quality_by_perplexity(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_windows(_table(spark, sf_dir), 35, with_text=False)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir), size=2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(_table(spark, sf_dir), _table(spark, sf_dir, "labels")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(_table(spark, sf_dir)).withColumn("fingerprint", simhash.hexadecimal("fingerprint"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(_table(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scans, op2_token_ids, op3_pii, op4_license_scans, op5_quality_classifier, op6_substring_dedup, op7_near_dedup, op8_decontamination, op9_quality_rules, op10_packing,
        op11_simhash_dedup, op12_embedding_whitening, op13_fill_in_middle,
    )
}

#: The other operators learn or tokenise, which SQL does not; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {"op1_secret_scans": oracles.OP1, "op6_substring_dedup": oracles.OP6, "op7_near_dedup": oracles.OP7, "op13_fill_in_middle": oracles.OP13}
