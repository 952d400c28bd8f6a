"""Quality rules by distribution divergence (DataFrame functions only).

Each text gives two histograms, of its character classes and of its language's common words. They are held against
the language's references, which are the sums over all documents of that language that pass the base rules, by
Jensen-Shannon distance. Short texts, whose histograms say little, are guarded by minimum lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch, free_name, let, words_of

#: Common words by language (fixed values); the histogram has one more bin for all other words.
COMMON = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "ist", "im"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
}
BINS = 13
#: Character classes that are counted; white space and all else (lower-case letters) come from the lengths.
CLASSES = (("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("mark", r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"), ("wide", r"[^\x00-\x7F]+"))


@dataclass(frozen=True)
class Limits:
    """Distances (0 to 1) beyond which a text is rejected, and the lengths below which they don't count."""

    #: Of 3,076 labelled good documents the farthest is at 0.21; junk begins at 0.3.
    chars: float = 0.25
    #: Halfway between the farthest of the good documents (0.27) and a text without any common word (0.30, where these words are a fifth of the language).
    common: float = 0.28
    min_chars: int = 300
    min_words: int = 80
    #: Documents that pass the base rules which a language needs for references of its own.
    min_documents: int = 20


def repeated_words(words: Column, width: int = 8) -> Column:
    """Words in windows of ``width`` words that the text has twice or more."""

    def covered(marks: Column) -> Column:
        step = lambda x, k: F.when(k == 0, F.lit(width)).otherwise(F.least(F.lit(width), x - F.get(marks, k - 1)))
        return F.aggregate(F.transform(marks, step), F.lit(0), lambda a, x: a + x)

    def twice(ordered: Column) -> Column:
        like = lambda x, k: F.coalesce(F.get(ordered, k).getField("h") == x.getField("h"), F.lit(False))
        same = F.filter(ordered, lambda x, k: like(x, k - 1) | like(x, k + 1))
        return let(F.sort_array(F.transform(same, lambda x: x.getField("i"))), covered)

    def of(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(pairs, twice)).otherwise(0)

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (width - 1))
        return let(F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, width))), of)

    return F.when(F.size(words) < width, F.lit(0)).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), windows))


def features(text: Column, lang: Column) -> Column:
    """All counts of a text as one struct."""
    text, lang = F.coalesce(text, F.lit("")), F.coalesce(lang, F.lit(""))
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    listed = F.array().cast("array<string>")
    for name, common in COMMON.items():
        listed = F.when(lang == name, F.array(*map(F.lit, common))).otherwise(listed)
    every = sorted({w for c in COMMON.values() for w in c})

    def of_words(words: Column) -> Column:
        hits = F.filter(words, lambda w: w.isin(every))
        counts = let(hits, lambda h: F.transform(listed, lambda k: F.size(F.filter(h, lambda w: w == k))))
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).cast("long").alias("n_repeat_words"), counts.alias("common"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        let(words_of(text), of_words).alias("words"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.length(text).cast("long").alias("chars"),
        *[without(pattern).cast("long").alias(name) for name, pattern in CLASSES],
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two histograms of counts; 0 if either is empty."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def share(a: Column) -> Column:
        return let(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), lambda total: F.transform(a, lambda x: x / total))

    def sums(a: Column, b: Column) -> Column:
        each = F.zip_with(a, b, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(each, F.lit(0.0), lambda s, x: s + x)))

    empty = lambda a: F.coalesce(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)) <= 0
    return F.when(empty(p) | empty(q), 0.0).otherwise(let(share(p), lambda a: let(share(q), lambda b: sums(a, b))))


def quality_rules(docs: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", carry: bool = False) -> DataFrame:
    """Counts and verdict of each document: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance, common_distance).

    With ``carry``, all columns of ``docs`` and only ``kept`` beside them (renamed with ``_`` if ``docs`` has one).
    Nulls count as empty texts, which fail the base rules; a null language is one of its own. Languages without
    references (too few documents) or without a word list pass that test. Repeated rows are judged each; ties
    at a limit pass; an empty table gives an empty result; other columns are left alone. Very long texts are taken whole.

    One narrow pass over the texts, whose counts are written out; the references are a map-side combined sum of
    19 numbers a language. They are broadcast while the languages are under 10,000, and joined otherwise.
    """
    scratch = Scratch(docs.sparkSession)
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("")) if lang_column in docs.columns else F.lit("")
    f = free_name(docs, "f")
    kept_columns = docs.columns if carry else [id_column]
    marked = scratch.save(docs.select(*kept_columns, F.struct(lang.alias("lang"), features(F.col(text_column), lang).alias("of")).alias(f)))
    of = lambda name: F.col(f"{f}.of.{name}")
    n_words, n_repeat = of("words.n_words"), of("words.n_repeat_words")
    failed = (n_words < 20) | (n_repeat * 100 > n_words * 30)
    space = of("chars") - of("word_chars")
    chars = [of(name) for name, _ in CLASSES]
    chars = [*chars, space, F.greatest(F.lit(0), of("chars") - space - sum(chars[1:], chars[0]))]
    common = [F.coalesce(F.get(of("words.common"), k), F.lit(0)) for k in range(BINS - 1)]
    common = [*common, n_words - sum(common[1:], common[0])]
    good = ~failed & (n_words >= limits.min_words)
    total = lambda columns: F.array(*[F.sum(F.when(good, c).otherwise(0)).cast("double") for c in columns])
    references = marked.groupBy(F.col(f"{f}.lang").alias("ref_lang")).agg(F.count(F.when(good, 1)).alias("n"), total(chars).alias("ref_chars"), total(common).alias("ref_common"))
    references = scratch.save(references.where(F.col("n") >= limits.min_documents).select("ref_lang", F.struct("ref_chars", "ref_common").alias("ref")))
    r = free_name(marked, "ref")
    references = references.select(F.col("ref_lang").alias(f"{r}_lang"), F.col("ref").alias(r))
    if references.count() < 10_000:
        references = F.broadcast(references)
    as_doubles = lambda columns: F.array(*[c.cast("double") for c in columns])
    judged = marked.join(references, F.col(f"{f}.lang") == F.col(f"{r}_lang"), "left")
    char_distance = F.coalesce(F.when(of("chars") >= limits.min_chars, js_distance(as_doubles(chars), F.col(f"{r}.ref_chars"))), F.lit(0.0))
    listed = F.size(of("words.common")) > 0
    common_distance = F.coalesce(F.when(listed & (n_words >= limits.min_words), js_distance(as_doubles(common), F.col(f"{r}.ref_common"))), F.lit(0.0))
    kept = ~failed & (char_distance <= limits.chars) & (common_distance <= limits.common)
    if carry:
        return judged.select(*docs.columns, kept.alias(free_name(docs, "kept")))
    return judged.select(
        id_column, n_words.alias("n_words"), of("word_chars").alias("word_chars"), of("n_symbols").alias("n_symbols"), of("n_dup_lines").alias("n_dup_lines"), n_repeat.alias("n_repeat_words"),
        failed.alias("base_failed"), kept.alias("kept"), char_distance.alias("char_distance"), common_distance.alias("common_distance"),
    )
