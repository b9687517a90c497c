"""What a parsed query says of itself: its nodes, their expressions, the tables it names."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

_SUBQUERIES = ("ScalarSubquery", "ListQuery", "Exists", "LateralSubquery")


def parsed(session: SparkSession, sql: str) -> JavaObject:
    """The query as Spark parses it, before any name is resolved."""
    return session._jsparkSession.sessionState().sqlParser().parsePlan(sql)


def kind(node: JavaObject) -> str:
    return node.getClass().getSimpleName()


def sequence(items: JavaObject) -> list[JavaObject]:
    return [items.apply(k) for k in range(items.size())]


def expressions(node: JavaObject) -> Iterator[JavaObject]:
    """An expression and all within it."""
    yield node
    for child in sequence(node.children()):
        yield from expressions(child)


def plans(node: JavaObject) -> Iterator[JavaObject]:
    """A node of a query and all below it."""
    yield node
    for child in sequence(node.children()):
        yield from plans(child)


def tables(plan: JavaObject, hidden: frozenset[str] = frozenset()) -> set[str]:
    """The tables a query names, in lower case; ``hidden`` are names it gives itself."""
    found: set[str] = set()
    if kind(plan) == "UnresolvedWith":
        for relation in sequence(plan.cteRelations()):
            # A name stands for the query from the next one on.
            found |= tables(relation._2(), hidden)
            hidden = hidden | {relation._1().lower()}
    if kind(plan) == "UnresolvedRelation":
        name = [part.lower() for part in sequence(plan.multipartIdentifier())]
        if len(name) > 1 or name[0] not in hidden:
            found.add(name[-1])
    for expression in sequence(plan.expressions()):
        for part in expressions(expression):
            if kind(part) in _SUBQUERIES:
                found |= tables(part.plan(), hidden)
    for child in sequence(plan.children()):
        found |= tables(child, hidden)
    return found
