"""Benchmark decontamination by spaced seeds (DataFrame functions only).

A mask says which of some consecutive tokens count; the others may differ. For each mask and place the tokens that count
are hashed, in the documents and in the benchmark, and equal hashes give (document, item, offset). Each such alignment
is then verified token by token: the best stretch, where a match adds 1 and a substitution takes off 1.5, must reach a score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch, let

#: 1: the token counts; 0: it may differ. Any 9 equal tokens in a row fit all of them.
MASKS = ("1110111", "11011011", "110100111")
PENALTY = 1.5
MIN_SCORE = 9.0
#: Of short items, so much of the length must be reached instead.
MIN_SHARE = 0.6
#: Rows (a few numbers each) that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; all characters beyond ASCII count as letters."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")


def seeds(words: Column, masks: Sequence[str] = MASKS) -> Column:
    """For each place one hash a mask (null where the mask reaches beyond the end), flat, by place and then mask."""
    shortest = min(map(len, masks))

    def one(hashes: Column, i: Column, k: int, mask: str) -> Column:
        chosen = [F.get(hashes, i + at) for at, c in enumerate(mask) if c == "1"]
        return F.when(i + len(mask) <= F.size(hashes), F.xxhash64(F.lit(k), *chosen))

    def of(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - shortest)
        return F.flatten(F.transform(places, lambda i: F.array(*[one(hashes, i, k, m) for k, m in enumerate(masks)])))

    return F.when(F.size(words) >= shortest, let(F.transform(words, lambda w: F.xxhash64(w)), of))


def _small(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def _whole(plain: DataFrame, items: DataFrame, shortest: int, scratch: Scratch) -> DataFrame:
    """(doc, item, offset) of the first place of each item under ``shortest`` tokens: runs of as many tokens with an equal hash."""
    short = scratch.save(items.withColumn("n", F.size("item_words")).where((F.col("n") > 0) & (F.col("n") < shortest)))
    lengths = sorted(r.n for r in short.select("n").distinct().collect())  # at most shortest - 1
    if not lengths:
        return short.select(F.lit(None).cast(plain.schema["doc"].dataType).alias("doc"), "item", F.lit(0).alias("offset")).limit(0)
    runs = ["1" * n for n in lengths]
    place, number = F.expr(f"cast(at div {len(runs)} as int)"), F.expr(f"at % {len(runs)}")
    wanted = short.select("item", "n", F.posexplode(seeds(F.col("item_words"), runs)).alias("at", "key"))
    wanted = wanted.where((place == 0) & (F.get(F.array(*map(F.lit, lengths)), number) == F.col("n"))).select("key", "item")
    found = plain.select("doc", F.posexplode(seeds(F.col("words"), runs)).alias("at", "key")).where("key is not null")
    return found.join(_small(scratch.save(wanted), BROADCAST_ROWS), "key").groupBy("doc", "item").agg(F.min(place).alias("offset"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS, min_score: float = MIN_SCORE, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text", short_items: bool = False
) -> DataFrame:
    """(id, item id, n_matched, n_compared, score) for each document that holds a benchmark item or a good part of it.

    n_matched of the n_compared aligned tokens are equal in the best alignment; its score is that of the best stretch.
    An item of few tokens needs 0.6 of its length instead of ``min_score``; items too short for the shortest mask are
    found only with ``short_items``, where they stand word for word. Nulls count as empty texts and give nothing, and so do rows without an
    id. Repeated rows give one result, of equal alignments the one with more matches counts; other columns are not read; empty tables
    give an empty result. Very long texts are taken whole.

    The documents are read twice, each time in a narrow pass: for the hashes, of which only those of the benchmark stay, and for
    the texts with an alignment; with ``short_items``, and where there are any, once more for theirs. Both joins broadcast while the small side is under a checked number of rows, and shuffle beyond.
    """
    scratch = Scratch(docs.sparkSession)
    plain = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc"), tokens(F.col(text_column)).alias("words"))
    items = scratch.save(benchmark.where(F.col(item_column).isNotNull()).select(F.col(item_column).alias("item"), tokens(F.col(item_text)).alias("item_words")).distinct())
    wanted = items.select("item", F.posexplode(seeds(F.col("item_words"), masks)).alias("at", "key")).where("key is not null")
    wanted = _small(scratch.save(wanted.select("key", "item", F.expr(f"cast(at div {len(masks)} as int)").alias("item_at")).distinct()), BROADCAST_ROWS)
    found = plain.select("doc", F.posexplode(seeds(F.col("words"), masks)).alias("at", "key"))
    hits = found.join(wanted, "key").select("doc", "item", F.expr(f"cast(at div {len(masks)} as int) - item_at").alias("offset")).distinct()
    if short_items:
        hits = hits.union(_whole(plain, items, min(map(len, masks)), scratch))
    hits = scratch.save(hits)

    aligned = plain.join(_small(hits, BROADCAST_ROWS), "doc").join(_small(items, 50_000), "item")
    low, high = F.greatest(F.lit(0), -F.col("offset")), F.least(F.size("item_words"), F.size("words") - F.col("offset"))
    mine, theirs = F.slice("words", F.col("offset") + low + 1, high - low), F.slice("item_words", low + 1, high - low)
    equal = F.zip_with(mine, theirs, lambda a, b: F.coalesce(a == b, F.lit(False)))
    start = F.struct(F.lit(0.0).alias("now"), F.lit(0.0).alias("best"), F.lit(0).alias("n"))

    def step(s: Column, same: Column) -> Column:
        now = F.greatest(F.lit(0.0), s.getField("now") + F.when(same, F.lit(1.0)).otherwise(F.lit(-PENALTY)))
        return F.struct(now.alias("now"), F.greatest(s.getField("best"), now).alias("best"), (s.getField("n") + same.cast("int")).alias("n"))

    judged = aligned.where(high > low).select("doc", "item", F.aggregate(equal, start, step).alias("s"), (high - low).alias("n_compared"), F.least(F.lit(min_score), F.size("item_words") * MIN_SHARE).alias("enough"))
    good = judged.where(F.col("s.best") >= F.col("enough"))
    best = good.groupBy("doc", "item").agg(F.max(F.struct(F.col("s.best").alias("score"), F.col("s.n").alias("n"), "n_compared")).alias("b"))
    return best.select(F.col("doc").alias(id_column), F.col("item").alias(item_column), F.col("b.n").cast("long").alias("n_matched"), F.col("b.n_compared").cast("long").alias("n_compared"), F.col("b.score").alias("score"))


def without_leaks(docs: DataFrame, leaks: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``leaks`` names; rows without an id stay."""
    bad = Scratch(docs.sparkSession).save(leaks.select(id_column).distinct())
    return docs.join(_small(bad, BROADCAST_ROWS), id_column, "left_anti").select(*docs.columns)
