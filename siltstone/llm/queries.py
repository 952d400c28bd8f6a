"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import sql
from siltstone.llm.bpe import bpe_encode
from siltstone.llm.chat import rotate_perspectives
from siltstone.llm.common import table
from siltstone.llm.decontamination import decontaminate
from siltstone.llm.jaccard import jaccard_join
from siltstone.llm.licences import document_path, licence_scan
from siltstone.llm.quality import quality_rules
from siltstone.llm.substrings import substring_dedup
from siltstone.llm.token_counts import token_counts
from siltstone.llm.toxicity import toxicity
from siltstone.llm.url_filter import url_filter

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("char_distance", "common_distance")


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"), document_path(F.col("source"), F.col("doc_id")))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(table(spark, sf_dir, "conversations"), keep_repeats=True)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_items=True)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return sql.ORACLES
