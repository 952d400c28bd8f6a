"""URL filters by a cascade of Bloom filters (DataFrame functions only).

The keys are all host suffixes of the corpus. Level 1 encodes the listed keys; level 2 the other keys
that level 1 wrongly takes; level 3 the listed keys that level 2 wrongly takes; and so on until no key is
wrong. A key is listed if the first level that lacks it is an even one, which is exact for every key of
the universe, and a row is judged by bit tests alone, with no join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch, lower_ascii

#: (verdict, host, path) of the explicit rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Hosts that are blocked, with their subdomains, where no rule fits.
LISTED_HOSTS = tuple(f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org"))
#: Bits of a level that travel inside the plan as a constant. Those of a larger level are written out and come as scalar subqueries, so
#: many words of 64 bits each.
MAX_BITS, CHUNK_WORDS = 1 << 23, 1 << 20


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def suffixes(host: Column) -> Column:
    """The host and all domains above it, as an array; none for an empty host."""
    labels = F.split(host, r"\.")
    each = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(each)


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits in arrays of ``chunk`` words, of which ``bits`` are in use; ``hashes`` bits a key."""

    salt: int
    bits: int
    hashes: int
    words: tuple[Column, ...] = ()
    chunk: int = CHUNK_WORDS

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.salt * 64 + i)), F.lit(self.bits)) for i in range(self.hashes)]

    def _word(self, k: Column) -> Column:
        if len(self.words) == 1:
            return F.get(self.words[0], k)
        found = F.when(k < self.chunk, F.get(self.words[0], k))
        for i, words in enumerate(self.words[1:], 1):
            found = found.when(k < (i + 1) * self.chunk, F.get(words, k - i * self.chunk))
        return found

    def has(self, key: Column) -> Column:
        found = F.lit(True)
        for p in self.positions(key):
            found = found & (_bit(self._word(F.shiftrightunsigned(p, 6).cast("int")), p) == 1)
        return found


def _bit(word: Column, position: Column) -> Column:
    return F.call_function("getbit", word, (position % 64).cast("int"))


def _words(set_bits: DataFrame, n: int, scratch: Scratch, max_bits: int, chunk: int) -> tuple[Column, ...]:
    """The words of a filter from rows (w, b): a constant, or for a larger one an array a chunk, each the row of a table of its own."""
    if n * 64 <= max(64, max_bits):
        words = [0] * n
        for r in set_bits.collect():  # at most max_bits / 64 rows
            words[r.w] = r.b
        return (F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>"),)  # folded once
    saved = scratch.save(set_bits)
    out = []
    for low in range(0, n, chunk):
        dense = scratch.spark.range(low, min(n, low + chunk)).join(saved.where((F.col("w") >= low) & (F.col("w") < low + chunk)), F.col("id") == F.col("w"), "left")
        row = dense.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0).cast("bigint")).alias("b")))).alias("x"))  # one chunk
        out.append(scratch.save(row.select(F.col("x.b").alias("words"))).scalar())
    return tuple(out)


def build_cascade(keys: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK_WORDS) -> list[Level]:
    """The levels for ``keys`` (key string, listed boolean; each key once).

    Two counts fix the size of level 1, so that it wrongly takes about half as many keys as are listed;
    later levels take half of the keys wrongly. All told that's about 1.5 * log2(keys / listed) + 6 bits a listed key.
    """
    scratch = Scratch(keys.sparkSession)
    n = {r.listed: r.n for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    listed, others = n.get(True, 0), n.get(False, 0)
    levels: list[Level] = []
    wrong = F.lit(True)  # of the keys on the side to encode: taken by all levels so far
    side, count = True, listed
    rate = min(0.5, listed * math.sqrt(0.5) / max(1, others))
    while count:
        if len(levels) == 64:  # each level halves what is wrong, so that even 2**64 keys end before
            raise RuntimeError("the cascade doesn't end")
        bits = max(64, math.ceil(count * math.log2(1 / rate) / math.log(2)))
        level = Level(len(levels) + 1, bits, max(1, round(math.log2(1 / rate))), chunk=chunk)
        at = keys.where((F.col("listed") == side) & wrong).select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
        set_bits = at.groupBy(F.shiftrightunsigned("p", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
        level = replace(level, words=_words(set_bits, (bits + 63) // 64, scratch, max_bits, chunk))
        levels.append(level)
        wrong = wrong & level.has(F.col("key"))
        side = not side
        count = keys.where((F.col("listed") == side) & wrong).count()
        rate = 0.5
    return levels


def in_cascade(levels: Sequence[Level], key: Column, k: int = 0) -> Column:
    """Whether a key of the universe is listed, given that the first ``k`` levels have it."""
    missing = F.lit(k % 2 == 1)
    if k == len(levels):
        return missing
    return F.when(levels[k].has(key), in_cascade(levels, key, k + 1)).otherwise(missing)


def url_filter(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, listed: Iterable[str] | DataFrame = LISTED_HOSTS, id_column: str = "page_id", url_column: str = "url", max_bits: int = MAX_BITS, chunk: int = CHUNK_WORDS
) -> DataFrame:
    """Judge each url: (id, host, path, rule, verdict), a row for each row of ``pages``.

    The longest fitting rule decides (a rule fits its host and subdomains if the path starts with the rule's; of equally long ones the
    first by text, and of two verdicts for one rule ``allow``); without one, a url is blocked if its host or a domain above it is in
    ``listed`` (strings, or a DataFrame with a column ``host``), of any size. Null, empty and odd urls have an empty host, which no rule
    and no list holds: they are allowed. Very long urls are taken whole. Repeated rows are judged each; other columns of ``pages`` are
    left out; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    judged = pages.select(F.col(id_column), url_host(F.col(url_column)).alias("host"), url_path(F.col(url_column)).alias("path"))
    universe = judged.select("host").distinct().select(F.explode(suffixes(F.col("host"))).alias("key")).distinct()
    if not isinstance(listed, DataFrame):
        listed = _strings(spark, sorted({x for x in listed if x}))
    on_list = listed.select(lower_ascii(F.col("host")).alias("key")).where("key <> ''").distinct().withColumn("found", F.lit(True))
    keys = scratch.save(universe.join(on_list, "key", "left").select("key", F.col("found").isNotNull().alias("listed")))
    levels = build_cascade(keys, max_bits, chunk)
    host, path = F.col("host"), F.col("path")
    if levels and len(levels[0].words) == 1:
        judged = judged.withColumn("blocked", F.exists(suffixes(host), lambda s: in_cascade(levels, s)))
    else:  # subqueries can't stand within a function of an array: one test for each of as many domains as a host may have above it
        judged = judged.withColumn("of", suffixes(host))
        most = judged.agg(F.coalesce(F.max(F.size("of")), F.lit(0))).first()[0] if levels else 0
        blocked = F.lit(False)
        for k in range(most):
            blocked = blocked | F.coalesce(in_cascade(levels, F.get("of", F.lit(k))), F.lit(False))
        judged = judged.withColumn("blocked", blocked)
    rule = verdict = None
    for said, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path) if rule is None else rule.when(fits, rule_host + rule_path)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    method = F.when(F.col("blocked"), "block").otherwise("allow")
    verdict = method if verdict is None else verdict.otherwise(method)
    rule = F.lit(None).cast("string") if rule is None else rule
    return judged.select(F.col(id_column), host, path, rule.alias("rule"), verdict.alias("verdict"))


def _strings(spark: SparkSession, values: list[str]) -> DataFrame:
    """A small column ``host`` made from the plan alone, without Python on the executors."""
    if not values:
        return spark.range(0).select(F.lit("").alias("host"))
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias("host"))
