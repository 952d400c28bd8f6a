"""Query trees compiled for their targets: streams, objects, rows, topics and the start of a search.

A stream or an object stands for many rows, so its condition is an upper bound: it holds for whatever may have a
matching row. Leaves that a target can't decide count as true, with or without NOT around them. The condition on
rows is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.plans.query import And, Leaf, Node, Not, Or, QueryError, fold_present, with_negation_at_leaves

HOUR, DAY = 3600, 86400
EARLIEST, LATEST = ("earliest", "index_earliest"), ("latest", "index_latest")
NAMES = ("index", "sourcetype", "host")
TERM = "indexstatement"
#: Gives the condition of a leaf on a target (the second argument: NOT stands before it), or None if it can't be decided there.
Decide = Callable[[Leaf, bool], Column | None]


def like_pattern(value: str, escape: bool = True) -> str:
    """``*`` becomes ``%``; other wildcards of LIKE stand for themselves (with ``escape``)."""
    if escape:
        for c in ("\\", "%", "_"):
            value = value.replace(c, "\\" + c)
    return value.replace("*", "%")


def matches(column: Column, leaf: Leaf, negated: bool = False, escape: bool = True) -> Column:
    """A name against a pattern, whatever the case; ``*`` alone takes all."""
    found = F.lit(True) if leaf.value == "*" else column.ilike(like_pattern(leaf.value, escape))
    return found if leaf.negative == negated else ~found


def epoch(leaf: Leaf) -> int:
    try:
        return int(leaf.value)
    except ValueError as e:
        raise QueryError(f"{leaf.tag} needs epoch seconds, not {leaf.value!r}") from e


def hour_floor(seconds: int) -> int:
    """The full hour at or before a time (towards 0 before 1970)."""
    rest = abs(seconds) % HOUR
    return seconds - rest if seconds >= 0 else seconds + rest


def upper_bound(node: Node, decide: Decide, strict: bool = False) -> Column:
    """True wherever the condition may hold; ``strict`` raises for leaves that can't be decided."""

    def bound(n: Node) -> Column:
        if isinstance(n, And | Or):
            left, right = bound(n.left), bound(n.right)
            return left & right if isinstance(n, And) else left | right
        leaf, negated = (n.child, True) if isinstance(n, Not) else (n, False)
        found = decide(leaf, negated)
        if found is None:
            if strict:
                raise QueryError(f"{leaf.tag} can't be decided here")
            return F.lit(True)
        return found

    return bound(with_negation_at_leaves(node))


def elided(node: Node, decide: Decide) -> Column:
    """Compatibility: leaves that can't be decided drop out, which under OR may lose rows."""
    found = fold_present(node, lambda x: decide(x, False), lambda a, b: a & b, lambda a, b: a | b, lambda a: ~a)
    return F.lit(True) if found is None else found


def on_streams(node: Node, index: Column, sourcetype: Column, host: Column, compat: bool = False, strict: bool = False, escape: bool = True) -> Column:
    """Which streams may have matching rows: names decide, times and terms don't."""
    columns = {"index": index, "sourcetype": sourcetype, "host": host}

    def decide(leaf: Leaf, negated: bool) -> Column | None:
        return matches(columns[leaf.tag], leaf, negated, escape) if leaf.tag in columns else None

    return elided(node, decide) if compat else upper_bound(node, decide, strict)


def on_objects(node: Node, names: dict[str, Column], logtime: Column, logdate: Column | None = None, term: Callable[[Leaf], Column | None] | None = None, compat: bool = False, strict: bool = False) -> Column:
    """Which hourly objects may have matching rows.

    ``logtime`` is the start of an object's hour in epoch seconds; ``logdate`` its day, by which catalogs are laid out, so that
    whole days are pruned. ``term`` gives the condition of a search term, such as a Bloom filter's; absence of a term from
    rows says nothing of an object, so that a negated term decides nothing.
    """

    def day(seconds: int) -> Column:
        return F.to_date(F.timestamp_seconds(F.lit(seconds)))

    def decide(leaf: Leaf, negated: bool) -> Column | None:
        if leaf.tag in NAMES:
            return matches(names[leaf.tag], leaf, negated)
        if leaf.tag in EARLIEST:
            at = epoch(leaf)
            if negated and not compat:
                return logtime < at
            near = logtime >= hour_floor(at)
            return near if logdate is None else near & (logdate >= day(hour_floor(at)))
        if leaf.tag in LATEST:
            at = epoch(leaf)
            if negated and not compat:
                return logtime + HOUR > at
            near = logtime <= at
            return near if logdate is None else near & (logdate <= day(at))
        if leaf.tag == TERM and term is not None and not leaf.negative and not negated:
            return term(leaf)
        return None

    return elided(node, decide) if compat else upper_bound(node, decide, strict)


def on_rows(node: Node, names: dict[str, Column], time: Column, raw: Column, strict: bool = False) -> Column:
    """The exact condition on events; ``time`` is in epoch seconds. A term is found anywhere in the raw text, whatever the case."""

    def decide(leaf: Leaf, negated: bool) -> Column | None:
        if leaf.tag in NAMES:
            return matches(names[leaf.tag], leaf, negated)
        if leaf.tag in EARLIEST:
            return time < epoch(leaf) if negated else time >= epoch(leaf)
        if leaf.tag in LATEST:
            return time > epoch(leaf) if negated else time <= epoch(leaf)
        if leaf.tag == TERM:
            found = F.contains(F.lower(raw), F.lit(leaf.value.lower()))
            return found if leaf.negative == negated else ~found
        return None

    return upper_bound(node, decide, strict)


def earliest_epoch(node: Node, now: int) -> int:
    """Where a search begins: the least of its earliest times and of one day ago, which every other condition stands for.

    NOT and latest say nothing; a query of these alone begins one day ago too.
    """

    def leaf(x: Leaf) -> int | None:
        if x.tag in LATEST:
            return None
        return min(epoch(x), now - DAY) if x.tag in EARLIEST else now - DAY

    def walk(n: Node) -> int | None:
        if isinstance(n, Leaf):
            return leaf(n)
        if isinstance(n, Not):
            return None
        found = [x for x in (walk(n.left), walk(n.right)) if x is not None]
        return min(found, default=None)

    found = walk(node)
    return now - DAY if found is None else found


def glob_regex(glob: str) -> str:
    """A regular expression (Java's) for a name pattern: ``*`` is any run and ``?`` any one character but ``/``."""
    out, plain = [], ""
    for c in glob + "\0":
        if c not in "*?\0":
            plain += c
            continue
        if plain:
            out.append(f"\\Q{plain}\\E")
            plain = ""
        out.append({"*": "[^/]*", "?": "[^/]", "\0": ""}[c])
    return f"^{''.join(out)}$"


def topic_regex(node: Node) -> str:
    """The topics that may hold matching events: equal indexes, joined by OR; AND of two and NOT narrow nothing."""

    def walk(n: Node) -> str | None:
        if isinstance(n, Leaf):
            return glob_regex(n.value) if n.tag == "index" and not n.negative else None
        if isinstance(n, Not):
            return None
        left, right = walk(n.left), walk(n.right)
        if isinstance(n, And):
            return None if left and right else left or right
        return f"({left}|{right})" if left and right else None

    return walk(node) or "^.*$"
