"""The tables a SQL text names, from its parsed plan: where they stand in the text, and the order that follows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

_IDENTIFIER = re.compile(r"(?:`(?:[^`]|``)*`|\w+)(?:\s*\.\s*(?:`(?:[^`]|``)*`|\w+))*")
_STREAM = re.compile(r"stream\b\s*\(?\s*", re.IGNORECASE)


@dataclass(frozen=True)
class Relation:
    """A table name in a SQL text: its parts, [start, end) of the name, and whether an alias may follow (none does yet)."""

    parts: tuple[str, ...]
    start: int
    end: int
    bare: bool


def _each(sequence):
    walk = sequence.iterator()
    while walk.hasNext():
        yield walk.next()


def relations(spark: SparkSession, sql: str) -> list[Relation]:
    """Every table or view the text reads, subqueries included; names of its own WITH clauses are none."""
    found: list[Relation] = []

    def visit(node, hidden: frozenset[str], above: str) -> None:
        kind = node.getClass().getSimpleName()
        inner = list(_each(node.innerChildren()))
        if kind == "UnresolvedWith":
            for cte in inner:  # each sees the ones before it
                visit(cte, hidden, kind)
                hidden = hidden | {cte.alias().lower()}
            inner = []
        if kind == "UnresolvedRelation":
            parts = tuple(_each(node.multipartIdentifier()))
            if len(parts) > 1 or parts[0].lower() not in hidden:
                start = node.origin().startIndex().get()  # in code points
                # STREAM(t) x: the origin covers all of it.
                lead = _STREAM.match(sql, start) if node.isStreaming() else None
                bare = not lead and above not in ("SubqueryAlias", "Sample", "RelationTimeTravel")
                found.append(Relation(parts, *_IDENTIFIER.match(sql, lead.end() if lead else start).span(), bare))
        for child in [*inner, *_each(node.children())]:
            visit(child, hidden, kind)

    visit(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql), frozenset(), "")
    return sorted(set(found), key=lambda r: r.start)


def renamed(spark: SparkSession, sql: str, name: Callable[[tuple[str, ...]], str | None]) -> str:
    """The text with the tables that ``name`` knows under other names; nothing else in it changes.

    A table without an alias keeps its name as one, as columns may be qualified by it.
    """
    for relation in reversed(relations(spark, sql)):
        other = name(relation.parts)
        if other is not None:
            alias = f" AS `{relation.parts[-1]}`" if relation.bare else ""
            sql = sql[: relation.start] + other + alias + sql[relation.end :]
    return sql


def ordered(names: list[str], needs: dict[str, Iterable[str]]) -> list[str]:
    """``names`` with each behind those it needs, otherwise as they come; a cycle is an error that shows it."""
    done: list[str] = []
    state: dict[str, str] = {}

    def place(name: str, path: list[str]) -> None:
        if state.get(name) == "done":
            return
        if name in path:
            raise ValueError("targets wait for each other: " + " -> ".join([*path[path.index(name) :], name]))
        for other in names:
            if other in needs.get(name, ()) and other != name:
                place(other, [*path, name])
        state[name] = "done"
        done.append(name)

    for name in names:
        place(name, [])
    return done
