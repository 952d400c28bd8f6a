"""Tokens of search terms and texts, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that part tokens: major ones always, minor ones give tokens of their own and all joins between them.
MAJOR = r"[\s\[\]<>(){}|!;,'\"*&?+]+|--"
MINOR = r"[/:=@.\-$#%\\_]"


def regex_tokens(text: Column, pattern: Column | str) -> Column:
    """All matches of a filter's pattern in a text."""
    return F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))


def delimiter_tokens(text: Column) -> Column:
    """Distinct runs of neighbouring pieces, where a piece is a minor delimiter or what stands between two.

    Of ``test.nest`` these are test, nest, ``.``, ``test.``, ``.nest`` and ``test.nest``.
    """
    majors = F.array_remove(F.split(text, MAJOR), "")

    def runs(major: Column) -> Column:
        pieces = F.regexp_extract_all(major, F.lit(rf"({MINOR}|(?:(?!{MINOR}).)+)"), 1)
        starts = F.sequence(F.lit(1), F.size(pieces))
        each = F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.size(pieces) - i + 1), lambda n: F.array_join(F.slice(pieces, i, n), "")))
        return F.when(F.size(pieces) > 0, F.flatten(each)).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.transform(majors, runs)))
