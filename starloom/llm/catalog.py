"""The queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import (
    centroids,
    exact,
    langid,
    lines,
    mix,
    near,
    pack,
    pages,
    phrases,
    pii,
    quality,
    secret_scan,
    substring,
)
from starloom.llm.common import documents
from starloom.llm.sql import SQL  # noqa: F401  (read by the driver entry)


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(documents(spark, sf_dir), vocabulary(pack.VOCABULARY))


def op2_pii_lstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(documents(spark, sf_dir), vocabulary(langid.VOCABULARY))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op5_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mixture(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.report(documents(spark, sf_dir))


def op10_substring_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(documents(spark, sf_dir))


def op11_ptolemaic_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_hat_trie_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.report(documents(spark, sf_dir))


def op13_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.report(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pack_curve, op2_pii_lstm_crf, op3_language_id, op4_secret_scan, op5_mix_curriculum, op6_quality_rules,
        op7_line_dedup, op8_exact_dedup, op9_near_dedup, op10_substring_rlz, op11_ptolemaic_centroids, op12_hat_trie_phrases,
        op13_site_templates)
}
