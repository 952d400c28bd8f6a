"""Pruning of objects by Bloom filters over search tokens, as relations.

A filter is the array of its set bit positions; a filter type (pattern, expected elements, false-positive rate) fixes its
size and its number of hashes. Filters: (partition_id, filter_type_id, bits). An object may hold a term if, for some type
whose pattern occurs in the term, all bits of the term's tokens are set, or if it has no filter of any such type.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.search_tokens import delimiter_tokens, regex_tokens


def shape(elements: int, rate: float) -> tuple[int, int]:
    """Bits and hashes of a filter for so many elements at a false-positive rate."""
    bits = max(64, math.ceil(-elements * math.log(rate) / math.log(2) ** 2 / 64) * 64)
    return bits, max(1, round(bits / elements * math.log(2)))


def positions(token: Column, bits: Column | int, hashes: Column | int) -> Column:
    """The bits of a token, which is compared without regard to case."""
    bits = F.lit(bits) if isinstance(bits, int) else bits
    hashes = F.lit(hashes) if isinstance(hashes, int) else hashes
    return F.transform(F.sequence(F.lit(1), hashes.cast("int")), lambda i: F.pmod(F.xxhash64(F.lower(token), i), bits).cast("int"))


def with_shape(types: DataFrame) -> DataFrame:
    """Filter types (id, expectedElements, targetFpp, pattern) with bits and hashes."""
    bits = F.greatest(F.lit(64), F.ceil(-F.col("expectedElements") * F.log("targetFpp") / (math.log(2) ** 2) / 64) * 64)
    return types.withColumn("bits", bits.cast("int")).withColumn("hashes", F.greatest(F.lit(1), F.round(F.col("bits") / F.col("expectedElements") * math.log(2))).cast("int"))


def tokens_of(text: Column, pattern: Column) -> Column:
    """By the type's pattern, or by delimiters where it has none."""
    return F.when(pattern.isNull(), delimiter_tokens(text)).otherwise(regex_tokens(text, pattern))


def build(texts: DataFrame, types: DataFrame) -> DataFrame:
    """Filters of texts (partition_id, text): an object's distinct tokens are taken before their bits, and both are combined where they lie before a shuffle."""
    kinds = with_shape(types).select("id", "bits", "hashes", "pattern").collect()  # a handful, of which each text gets all
    shapes = F.array(*[F.struct(F.lit(k.id).alias("id"), F.lit(k.bits).alias("bits"), F.lit(k.hashes).alias("hashes"), F.lit(k.pattern).cast("string").alias("pattern")) for k in kinds])
    each = texts.select("partition_id", "text", F.explode(shapes).alias("t"))
    each = each.select("partition_id", F.col("t.id").alias("filter_type_id"), "t.bits", "t.hashes", F.explode(F.array_distinct(F.transform(tokens_of(F.col("text"), F.col("t.pattern")), lambda x: F.lower(x)))).alias("token"))
    token = each.distinct()
    bit = token.select("partition_id", "filter_type_id", F.explode(positions(F.col("token"), F.col("bits"), F.col("hashes"))).alias("bit"))
    return bit.groupBy("partition_id", "filter_type_id").agg(F.sort_array(F.collect_set("bit")).alias("bits"))


def relevant_types(types: DataFrame, term: str) -> DataFrame:
    """Types whose pattern occurs in a term: with the term's bits. A type without a pattern is relevant if the term has tokens."""
    text = F.lit(term)
    shaped = with_shape(types).withColumn("tokens", F.array_distinct(tokens_of(text, F.col("pattern"))))
    bits = F.array_distinct(F.flatten(F.transform("tokens", lambda t: positions(t, F.col("bits"), F.col("hashes")))))
    return shaped.where(F.size("tokens") > 0).select(F.col("id").alias("filter_type_id"), bits.alias("term_bits"))


def may_hold(filters: DataFrame, types: DataFrame, term: str) -> DataFrame:
    """(partition_id, hit) of the objects with a filter of a relevant type; an object without one isn't here and may hold the term."""
    relevant = F.broadcast(relevant_types(types, term))
    hit = F.size(F.array_except("term_bits", "bits")) == 0
    return filters.where(F.col("bits").isNotNull()).join(relevant, "filter_type_id").groupBy("partition_id").agg(F.max(hit).alias("hit"))


def prune(objects: DataFrame, filters: DataFrame, types: DataFrame, term: str, key: str = "id") -> DataFrame:
    """Objects that may hold a term; all of them if no type is relevant."""
    said = may_hold(filters, types, term).select(F.col("partition_id").alias(key), "hit")
    return objects.join(said.where(~F.col("hit")), key, "left_anti")


def without_filters(objects: DataFrame, filters: DataFrame, types: DataFrame, pattern: str, key: str = "id") -> DataFrame:
    """Objects that have no filter of the types with exactly this pattern."""
    chosen = F.broadcast(types.where(F.col("pattern") == pattern).select(F.col("id").alias("filter_type_id")))
    have = filters.where(F.col("bits").isNotNull()).join(chosen, "filter_type_id", "left_semi").select(F.col("partition_id").alias(key))
    return objects.join(have, key, "left_anti")
