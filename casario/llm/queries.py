"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casario.llm import (
    credentials, decontamination, licenses, manifest, mixing, neardup, pii, ppm, quality, sharding, spelling, toxicity, url_templates,
)

#: Target weights; sources that are not named have weight 1.
WEIGHTS = {"src0": 4, "src1": 2, "src2": 2}
BLOCK_BYTES = 1 << 16
SHARD_BYTES = 1 << 20
#: Bytes of the longest context of the language model.
PPM_ORDER = 5


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.slots(_read(spark, sf_dir, "documents"), WEIGHTS, BLOCK_BYTES)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secrets(_read(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judged(_read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "template")


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(_read(spark, sf_dir, "documents"), PPM_ORDER)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_read(spark, sf_dir, "documents"), SHARD_BYTES)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.checked(_read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_decontamination": op2_decontamination,
        "op3_mixing": op3_mixing,
        "op4_secrets": op4_secrets,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_url_filter": op6_url_filter,
        "op7_ppm": op7_ppm,
        "op8_sharding": op8_sharding,
        "op9_licenses": op9_licenses,
        "op10_quality": op10_quality,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_toxicity": op13_toxicity,
    }
