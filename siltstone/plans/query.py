"""The query language: a small XML boolean expression, parsed into a tree and rewritten.

``AND`` and ``OR`` join two branches, ``NOT`` negates one, and every other element is a leaf: a tag such as ``index``,
``host`` or ``earliest`` with a ``value`` and an ``operation``.
"""

from __future__ import annotations

import xml.etree.ElementTree as ElementTree
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TypeVar

Out = TypeVar("Out")


class QueryError(ValueError):
    """A query that can't be read, or (in strict use) one that asks for what a target lacks."""


@dataclass(frozen=True)
class Leaf:
    tag: str
    value: str
    operation: str = "EQUALS"

    @property
    def negative(self) -> bool:
        """Any operation but NOT_EQUALS means equality."""
        return self.operation.upper() == "NOT_EQUALS"


@dataclass(frozen=True)
class And:
    left: Node
    right: Node


@dataclass(frozen=True)
class Or:
    left: Node
    right: Node


@dataclass(frozen=True)
class Not:
    child: Node


Node = Leaf | And | Or | Not


def parse(xml: str) -> Node:
    """The tree of a query. White space between elements and the case of operators don't matter."""
    try:
        root = ElementTree.fromstring(xml)
    except ElementTree.ParseError as e:
        raise QueryError(f"not XML: {e}") from e
    return _node(root)


def _node(element: ElementTree.Element) -> Node:
    name, children = element.tag.upper(), [_node(c) for c in element]
    if name in ("AND", "OR"):
        if len(children) == 1:
            return children[0]
        if len(children) != 2:
            raise QueryError(f"{name} needs one or two branches, not {len(children)}")
        return (And if name == "AND" else Or)(*children)
    if name == "NOT":
        if len(children) != 1:
            raise QueryError(f"NOT needs one branch, not {len(children)}")
        return Not(children[0])
    if children:
        raise QueryError(f"{element.tag} can't have branches")
    for needed in ("value", "operation"):
        if needed not in element.attrib:
            raise QueryError(f"{element.tag} lacks {needed}")
    return Leaf(element.tag.lower(), element.attrib["value"], element.attrib["operation"])


def leaves(node: Node) -> Iterator[Leaf]:
    """All leaves, from left to right."""
    if isinstance(node, Leaf):
        yield node
    elif isinstance(node, Not):
        yield from leaves(node.child)
    else:
        yield from leaves(node.left)
        yield from leaves(node.right)


def with_negation_at_leaves(node: Node, negated: bool = False) -> Node:
    """The same condition with NOT only around leaves."""
    if isinstance(node, Leaf):
        return Not(node) if negated else node
    if isinstance(node, Not):
        return with_negation_at_leaves(node.child, not negated)
    kind = And if isinstance(node, And) != negated else Or
    return kind(with_negation_at_leaves(node.left, negated), with_negation_at_leaves(node.right, negated))


def fold(node: Node, leaf: Callable[[Leaf], Out], both: Callable[[Out, Out], Out], either: Callable[[Out, Out], Out], no: Callable[[Out], Out]) -> Out:
    """A value for the tree from values for its leaves."""
    again = lambda n: fold(n, leaf, both, either, no)
    if isinstance(node, Leaf):
        return leaf(node)
    if isinstance(node, Not):
        return no(again(node.child))
    return (both if isinstance(node, And) else either)(again(node.left), again(node.right))


def fold_present(node: Node, leaf: Callable[[Leaf], Out | None], both: Callable[[Out, Out], Out], either: Callable[[Out, Out], Out], no: Callable[[Out], Out]) -> Out | None:
    """As ``fold``, but branches without a value (None) drop out and leave the other one."""

    def joined(f: Callable[[Out, Out], Out]) -> Callable[[Out | None, Out | None], Out | None]:
        return lambda a, b: b if a is None else a if b is None else f(a, b)

    return fold(node, leaf, joined(both), joined(either), lambda a: None if a is None else no(a))


def explain(node: Node, depth: int = 0) -> str:
    """The tree as indented text."""
    pad = "  " * depth
    if isinstance(node, Leaf):
        return f"{pad}{node.tag} {node.operation} {node.value!r}"
    if isinstance(node, Not):
        return f"{pad}NOT\n{explain(node.child, depth + 1)}"
    return f"{pad}{type(node).__name__.upper()}\n{explain(node.left, depth + 1)}\n{explain(node.right, depth + 1)}"
