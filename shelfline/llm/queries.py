"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import (bpe, chat, decontaminate, divergence, licenses, merkle, mixing, packing, quality, resampling, simhash,
                           suffix, toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, by the installed package that holds them."""
    if os.environ.get("SHELFLINE_TOKENIZERS"):
        return os.path.join(os.environ["SHELFLINE_TOKENIZERS"], name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_report(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_report(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_report(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(_table(spark, sf_dir, "conversations"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_report(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_quality, op3_suffix_dedup, op4_simhash, op5_decontaminate, op6_merkle, op7_toxicity,
        op8_token_counts, op9_chat_format, op10_mix_sources,
        op11_resample, op12_pack, op13_divergence)
}

SQL: dict[str, str] = {
    "op5_decontaminate": decontaminate.REPORT_SQL,
    "op9_chat_format": chat.REPORT_SQL,
    "op10_mix_sources": mixing.REPORT_SQL,
    "op11_resample": resampling.REPORT_SQL,
    "op13_divergence": divergence.REPORT_SQL,
}
