"""Chat formatting by perspective rotation.

A dialogue is rendered once for each of its speakers: that one as the assistant, all others as named users. What the
assistant says is what a model learns from, so its spans are returned as masks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch, small

#: Turns of a dialogue that one row renders; longer dialogues have several rows, in order of ``block``.
TURNS = 64
#: Blocks of a dialogue that meet its speakers together.
BLOCKS = 1024
#: How a turn is written (fixed values of this format).
OPEN, MIDDLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def escaped(text: Column) -> Column:
    r"""Text in which nothing can pass for a marker: ``<|`` becomes ``<\|``, and one more backslash goes into what looks like that already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def shown(name: Column) -> Column:
    """A speaker's name as a header shows it: white space and the characters of markers become ``_``."""
    return F.regexp_replace(name, r"[\s|<>]+", "_")


def _parted(said: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """Rows with ``part``: 0, or for turn numbers with over ``most`` rows one of as many parts as it takes.

    Equal rows of such a turn are counted before they meet, and dealt to parts ``most`` at a time.
    """
    turn = ["conv", "block", "turn"]
    crowded = scratch.save(said.groupBy(*turn).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*[F.col(c).alias(f"of_{c}") for c in turn], F.ceil(F.col("n") / most).alias("parts")))
    plain = F.lit(0).cast("bigint").alias("part")
    if crowded.isEmpty():
        return said.select(*turn, "who", "text", plain)
    same = F.col("conv").eqNullSafe(F.col("of_conv")) & F.col("turn").eqNullSafe(F.col("of_turn"))
    rest = said.join(small(crowded), same, "left_anti").select(*turn, "who", "text", plain)
    counted = said.join(small(crowded), same, "left_semi").groupBy(*turn, "who", "text").agg(F.count("*").alias("n"))
    piles = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / most))).alias("pile"))
    piles = piles.join(small(crowded), same).withColumn("part", F.pmod(F.xxhash64("who", "text", "pile"), "parts"))
    copies = F.least(F.lit(most), F.col("n") - F.col("pile") * most).cast("int")
    return rest.unionAll(piles.select(*turn, "who", F.explode(F.array_repeat("text", copies)).alias("text"), "part"))


def rotate_perspectives(turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", speaker_column: str = "role", text_column: str = "text", turns_per_row: int = TURNS, keep_repeats: bool = False) -> DataFrame:
    """(conv, speaker, block, part, n_turns, n_own, rendered, masks): each dialogue as each of its speakers sees it.

    ``rendered`` writes the turns of a block in order; ``masks`` are (start, length) in characters of the assistant's words in it, as they are
    written. Markers within texts and names are escaped, so that a text can't forge a turn.

    A block is turn number div ``turns_per_row``, so that even a dialogue with a third of all turns is spread over tasks; a turn number that
    over ``turns_per_row`` rows share has its rows dealt to parts of about so many, by their speaker and text. So each row is bounded, and very
    long dialogues are rendered whole, as several rows; very long texts are taken whole. Only the ids of blocks and the speakers meet by dialogue, not the texts.
    A perspective has a row for each block of its dialogue, also for those in which it is silent. Null texts count as empty, a null
    speaker as ``unknown``, and a null turn number comes first, as block -1. Turns with equal numbers go by speaker and text; equal rows
    count once, or with ``keep_repeats`` as often as they occur. Rows without a conversation are one conversation, whose id is null.
    Other columns are not read; an empty table gives an empty result.
    """
    scratch = Scratch(turns.sparkSession)
    speaker = F.coalesce(F.nullif(F.trim(F.col(speaker_column)), F.lit("")), F.lit("unknown"))
    n = F.col(turn_column)
    block = F.coalesce(F.floor(n / turns_per_row), F.lit(-1)).cast("bigint")
    said = turns.select(F.col(conv_column).alias("conv"), block.alias("block"), n.alias("turn"), speaker.alias("who"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    parted = _parted(said if keep_repeats else said.distinct(), scratch, turns_per_row)
    blocks = parted.groupBy("conv", "block", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "who", "text"))).alias("turns"))

    speakers = said.select(F.col("conv").alias("of"), F.col("who").alias("speaker")).distinct()
    ids = said.select("conv", F.col("block").alias("b")).distinct()
    some = F.floor(F.col("b") / BLOCKS)
    groups = ids.select("conv", some.alias("group")).distinct().join(speakers, F.col("conv").eqNullSafe(F.col("of"))).select("of", "group", "speaker")
    seen = ids.join(groups, F.col("conv").eqNullSafe(F.col("of")) & (some == F.col("group"))).select("of", "b", "speaker")
    each = blocks.join(seen, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("b"))).drop("of", "b")

    def head(t: Column) -> Column:
        name = F.when(t["who"] == F.col("speaker"), F.lit("assistant")).otherwise(F.concat(F.lit("user name="), shown(t["who"])))
        return F.concat(F.lit(OPEN), name, F.lit(MIDDLE))

    pieces = F.transform("turns", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"), (t["who"] == F.col("speaker")).alias("own")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(s: Column, p: Column) -> Column:
        begin, long = s["at"] + F.length(p["head"]), F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), long.alias("length")))
        return F.struct((begin + long + len(CLOSE)).alias("at"), F.when(p["own"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    each = each.withColumn("pieces", pieces)
    return each.select(
        F.col("conv").alias(conv_column), "speaker", "block", "part", F.size("turns").alias("n_turns"), F.size(F.filter("pieces", lambda p: p["own"])).alias("n_own"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("rendered"), F.aggregate("pieces", start, step, lambda s: s["spans"]).alias("masks"),
    )
