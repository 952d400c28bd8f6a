"""Query conditions in Arrow, for planning over catalog tables and for readers that don't run in Spark's engine.

The same functions take arrays, where they decide rows at once, and dataset fields, where they are pushed into a scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc

from siltstone.plans.conditions import EARLIEST, HOUR, LATEST, NAMES, TERM, epoch, hour_floor, like_pattern
from siltstone.plans.query import And, Leaf, Node, Not, Or, with_negation_at_leaves

#: An array of booleans, a scalar (the same for all rows) or an expression over a dataset.
Mask = Any
MICROS = 1_000_000


def _not(m: Mask) -> Mask:
    return pc.invert(m)


def _bound(node: Node, decide: Callable[[Leaf, bool], Mask | None], true: Mask) -> Mask:
    if isinstance(node, And | Or):
        left, right = _bound(node.left, decide, true), _bound(node.right, decide, true)
        return pc.and_kleene(left, right) if isinstance(node, And) else pc.or_kleene(left, right)
    found = decide(node.child, True) if isinstance(node, Not) else decide(node, False)
    return true if found is None else found


def _named(column: Any, leaf: Leaf, negated: bool) -> Mask:
    like = pc.match_like(column, like_pattern(leaf.value), ignore_case=True)
    return like if leaf.negative == negated else _not(like)


def object_may_match(node: Node, names: Mapping[str, Any], logtime: Any, true: Mask, term: Callable[[Leaf], Mask] | None = None) -> Mask:
    """Whether hourly objects may hold a row for the query; what can't be decided counts as true.

    Without ``logtime``, of streams, only names decide. ``term`` decides search terms that aren't negated.
    """

    def decide(leaf: Leaf, negated: bool) -> Mask | None:
        if leaf.tag in NAMES:
            return _named(names[leaf.tag], leaf, negated)
        if leaf.tag in EARLIEST + LATEST and logtime is None:
            return None
        if leaf.tag in EARLIEST:
            return pc.less(logtime, epoch(leaf)) if negated else pc.greater_equal(logtime, hour_floor(epoch(leaf)))
        if leaf.tag in LATEST:
            return pc.greater(logtime, epoch(leaf) - HOUR) if negated else pc.less_equal(logtime, epoch(leaf))
        if leaf.tag == TERM and term is not None and not leaf.negative and not negated:
            return term(leaf)
        return None

    return _bound(with_negation_at_leaves(node), decide, true)


def rows_match(node: Node, names: Mapping[str, pa.Array], time: pa.Array, raw: pa.Array) -> pa.Array:
    """The exact condition on events."""
    micros = time.cast(pa.int64())

    def decide(leaf: Leaf, negated: bool) -> Mask | None:
        if leaf.tag in NAMES:
            return _named(names[leaf.tag], leaf, negated)
        if leaf.tag in EARLIEST:
            return (pc.less if negated else pc.greater_equal)(micros, epoch(leaf) * MICROS)
        if leaf.tag in LATEST:
            return (pc.greater if negated else pc.less_equal)(micros, epoch(leaf) * MICROS)
        if leaf.tag == TERM:
            found = pc.match_substring(raw, leaf.value, ignore_case=True)
            return found if leaf.negative == negated else _not(found)
        return None

    found = _bound(with_negation_at_leaves(node), decide, pa.scalar(True))
    return pa.array([found.as_py()] * len(raw), pa.bool_()) if isinstance(found, pa.Scalar) else found
