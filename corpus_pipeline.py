"""Corpus pipeline: documents pass the stages of STAGES in order; each stage works on
all that its predecessor kept, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontaminate, mixing, quality, simhash, suffix
from shelfline.llm.common import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier, fitted on this stage's input, does not reject."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest doc_id, of each SimHash component."""
    return simhash.drop_near_duplicates(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that another document has too; the
    documents all stay, some with a shorter text.  Rows as in ``suffix.remove_repeats``."""
    return suffix.remove_repeats(docs, suffix.PASSAGE_LENGTH, suffix.PASSAGE_GRAM, suffix.PASSAGE_WORDS, across=True)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: a row for each copy taken, with mix_position and
    mix_words, range-sorted by position."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeat_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing to target weights", mixing_stage),
]

#: None: SQL can express neither the fitted classifier nor XXH64 fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the documents of ``sf_dir``.  Stage results lie in the shared
    folder, so a lost executor repeats part of one stage at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{i + 1}")
    return docs
