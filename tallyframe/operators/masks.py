"""Many conditions counted through one bit mask a row.

Refined conditions repeat their parents' tests: the standard report's 119 distinct counts are made of 39 tests. Conditions are
cut at their ANDs and ORs into atoms. A row sets one bit for each atom that is true (false and NULL count the same under AND and
OR), so each is evaluated once, and a condition is a comparison of bits. Atoms beyond ``WIDTH`` go to further masks. Tasks
still send one row per subset to the shuffle. Counting rows by subset and mask first, and conditions on that histogram,
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.conditions import Condition, Tree, faithful
from tallyframe.operators.counts import lenient, quoted, wrapped

#: Bits of one mask.
WIDTH = 62


def _atoms(tree: Tree) -> set[str]:
    return {tree} if isinstance(tree, str) else set().union(*map(_atoms, tree[1]))


def _on_masks(tree: Tree, place: Mapping[str, int]) -> str:
    """The condition as SQL over the masks."""
    kind, operands = tree if isinstance(tree, tuple) else ("And", [tree])
    bits: dict[int, int] = {}
    for atom in operands:
        if isinstance(atom, str):
            m, b = divmod(place[atom], WIDTH)
            bits[m] = bits.get(m, 0) | 1 << b
    parts = [f"(mask{m} & {b}L) = {b}L" if kind == "And" else f"(mask{m} & {b}L) <> 0L" for m, b in bits.items()]
    parts += [f"({_on_masks(x, place)})" for x in operands if not isinstance(x, str)]
    return f" {kind.upper()} ".join(parts)


def mask_counts(data: DataFrame, conditions: Mapping[str, str], analysis: Mapping[str, Condition], subset: Column | None = None) -> DataFrame:
    """The result of ``group_counts`` for conditions with their ``analysis`` by text.

    Spark's own text of an atom is used only where Spark reads it as the same expression again; else the condition is one atom as it is written.
    """
    trees: dict[str, Tree] = {name: analysis[text].tree for name, text in conditions.items()}
    sure = faithful(data, sorted(set().union(*map(_atoms, trees.values()))))
    trees = {name: tree if _atoms(tree) <= sure else wrapped(conditions[name]) for name, tree in trees.items()}
    place = {atom: i for i, atom in enumerate(dict.fromkeys(a for tree in trees.values() for a in sorted(_atoms(tree))))}
    masks: dict[int, list[str]] = {}
    for atom, i in place.items():
        masks.setdefault(i // WIDTH, []).append(f"CASE WHEN {atom} THEN {1 << i % WIDTH}L ELSE 0L END")
    keys = [] if subset is None else [subset.alias("subset")]
    with lenient(data.sparkSession):
        rows = data.select(*keys, *[F.expr(" | ".join(bits)).alias(f"mask{m}") for m, bits in masks.items()])
    counters = [F.expr(f"count(CASE WHEN {_on_masks(tree, place)} THEN 1 END) AS {quoted(name)}") for name, tree in trees.items()]
    return rows.agg(*counters) if subset is None else rows.groupBy("subset").agg(*counters)
