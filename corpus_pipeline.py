"""From raw documents to token ids: the stages of the training-text pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; docs is what the stage before it wrote. All but the last
return the columns of ``docs``, which are those of ``documents`` and any others, whatever their names. An empty table gives an empty one.
Very long texts are taken whole throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.bpe import bpe_encode
from siltstone.llm.common import Scratch, free_name, small, table
from siltstone.llm.decontamination import decontaminate, without_leaks
from siltstone.llm.jaccard import jaccard_join
from siltstone.llm.quality import quality_rules
from siltstone.llm.substrings import substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the histograms reject go.

    Null and empty texts have under 20 words and go; a null language is one of its own; ties at a limit stay; repeated rows
    and rows without an id are judged each.
    """
    judged = quality_rules(docs, carry=True)
    return judged.where(judged.columns[-1]).select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row for each id (null too) and text. Only rows whose id occurs again are shuffled with their texts."""
    again, rest = free_name(docs, "again"), free_name(docs, "rest")
    saved = Scratch(spark).save(docs.groupBy(F.col("doc_id").alias(again)).count().where("count > 1").select(again))
    if saved.isEmpty():
        return docs
    same = F.col("doc_id").eqNullSafe(F.col(again))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = docs.join(small(saved), same, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias(rest)).select("doc_id", "text", f"{rest}.*")
    return docs.join(small(saved), same, "left_anti").unionByName(one).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays.

    Of rows with the same id and text one stays, with the least of its other columns. Texts without words are linked with
    nothing and stay, and so do rows without an id.
    """
    scratch = Scratch(spark)
    groups = jaccard_join(docs)
    gone = scratch.save(groups.where("doc_id <> component_id").select("doc_id").distinct())
    return without_repeats(spark, docs).join(small(gone), "doc_id", "left_anti").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occur earlier (a smaller id, or further up) are cut, and n_chars follows.

    Null texts stay null, and rows without an id as they are; rows that share an id count as one document; a text of repeats alone
    becomes empty.
    """
    return substring_dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go, with all rows of their id. Null and empty texts hold none; rows without an id stay."""
    return without_leaks(docs, decontaminate(docs, table(spark, sf_dir, "benchmark"), short_items=True))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with their number and hashes: a row for each row. Null and empty texts have no ids."""
    return bpe_encode(docs, keep=("doc_id", "lang", "source"), with_ids=True)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", substrings), ("benchmark decontamination", benchmark_leaks), ("BPE encoding and decoding", tokens)]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
