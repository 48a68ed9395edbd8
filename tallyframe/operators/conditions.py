"""Conditions as Spark analyzes them: their expressions, and what they are made of under AND and OR."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.counts import lenient, wrapped

#: An atom as SQL text, or "And" / "Or" with its operands.
Tree = str | tuple[str, list]


@dataclass
class Node:
    """One expression of an analyzed condition."""

    kind: str
    value: str | None
    children: list[Node]
    given: list[dict] = field(repr=False)

    def leaves(self, path: tuple[int, ...] = ()) -> Iterator[tuple[tuple[int, ...], Node]]:
        """Operands of ANDs and ORs that are neither themselves, with the way to them."""
        if self.kind not in ("And", "Or"):
            yield path, self
        else:
            for i, child in enumerate(self.children):
                yield from child.leaves((*path, i))


@dataclass
class Condition:
    """A condition that Spark accepts as a counter."""

    node: Node
    tree: Tree


def _node(nodes: list[dict], start: int) -> tuple[Node, int]:
    """The expression that starts at a place of a list in which each node is followed by its children, and where it ends."""
    given, at, children = nodes[start], start + 1, []
    for _ in range(given["num-children"]):
        child, at = _node(nodes, at)
        children.append(child)
    value = given.get("value")
    return Node(given["class"].rsplit(".", 1)[-1], value if isinstance(value, str) else None, children, nodes[start:at]), at


def _analyzed(empty: DataFrame, texts: list[str], known: dict[str, str]) -> list[Condition | None]:
    """The counters' conditions; None for a text that is no boolean. Raises if Spark rejects any of them."""
    fields = empty.select(*[F.expr(text) for text in texts]).schema.fields
    counters = empty.agg(*[F.expr(f"count(CASE WHEN {wrapped(text)} THEN 1 END) AS n{i}") for i, text in enumerate(texts)])
    plan = counters._jdf.queryExecution().analyzed()
    listed = json.loads(plan.toJSON())[0]["aggregateExpressions"]

    def tree(node: Node, sqls: Iterator[str]) -> Tree:
        if node.kind not in ("And", "Or"):
            return next(sqls)
        operands: list[Tree] = []
        for child in node.children:
            part = tree(child, sqls)
            operands += part[1] if isinstance(part, tuple) and part[0] == node.kind else [part]
        return node.kind, operands

    out: list[Condition | None] = []
    for i, (nodes, f) in enumerate(zip(listed, fields)):
        if f.dataType.typeName() not in ("boolean", "void"):
            out.append(None)
            continue
        condition = _node(nodes, 0)[0]
        for _ in range(4):  # alias, aggregate, count, case
            condition = condition.children[0]
        sqls = []
        for path, leaf in condition.leaves():
            key = json.dumps(leaf.given)
            if key not in known:
                expression = plan.aggregateExpressions().apply(i)
                for step in (0, 0, 0, 0, *path):
                    expression = expression.children().apply(step)
                known[key] = expression.sql()
            sqls.append(known[key])
        out.append(Condition(condition, tree(condition, iter(sqls))))
    return out


def analyze(data: DataFrame, texts: Iterable[str]) -> dict[str, Condition | None]:
    """Each text's condition over the data's columns, None where Spark rejects it as a counter. Runs no job.

    A text has to stand on its own too, or unbalanced parentheses would slip through the added ones.
    """
    texts = list(dict.fromkeys(texts))
    if not texts:
        return {}
    with lenient(data.sparkSession):
        empty = data.sparkSession.createDataFrame([], data.schema)
        try:
            return dict(zip(texts, _analyzed(empty, texts, {})))
        except PySparkException:
            return {text: _alone(empty, text) for text in texts}


def _alone(empty: DataFrame, text: str) -> Condition | None:
    try:
        return _analyzed(empty, [text], {})[0]
    except PySparkException:
        return None


def faithful(data: DataFrame, atoms: list[str]) -> set[str]:
    """Atoms whose text Spark reads as the same expression again."""

    def same(some: list[str]) -> set[str]:
        columns: list[Column] = [F.expr(text).alias(f"a{i}") for i, text in enumerate(some)]
        read = empty.select(*columns)._jdf.queryExecution().analyzed().projectList()
        return {text for i, text in enumerate(some) if read.apply(i).child().sql() == text}

    found: set[str] = set()
    with lenient(data.sparkSession):
        empty = data.sparkSession.createDataFrame([], data.schema)
        try:
            return same(atoms)
        except PySparkException:
            for text in atoms:
                try:
                    found |= same([text])
                except PySparkException:
                    continue
    return found
