"""Report cells declared as data.

A cell is a filtered row count, an exact median of one column over filtered rows,
a refinement of another cell's filter, or the ratio of two cells. Conditions are
Spark SQL boolean text over the prepared columns; ``:name`` stands for a window
bound that is supplied when a report is run.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyframe import layout
from tallyframe.functions.local import local_table

COUNT, MEDIAN, REFINE, RATIO = "count", "median", "refine", "ratio"
KINDS = (COUNT, MEDIAN, REFINE, RATIO)

_BOUND = re.compile(r"(?<!:):([A-Za-z_]\w*)")


@dataclass(frozen=True)
class Cell:
    """One report cell as declared."""

    name: str
    kind: str
    predicate: str | None = None
    parent: str | None = None
    num: str | None = None
    den: str | None = None
    value: str = layout.WAGE_COLUMN
    note: str | None = None
    joiner: str = "AND"  # how a refinement attaches to its parent's condition


@dataclass(frozen=True)
class ResolvedCell:
    """A cell with its whole filter: ``kind`` is count, median, ratio, FAILED or MISSING."""

    name: str
    kind: str
    predicate: str | None = None
    num: str | None = None
    den: str | None = None
    value: str | None = None
    root: str | None = None
    depth: int = 0
    problem: str | None = None


class Catalog:
    """Ordered, immutable set of cells; of two cells with one name the later one counts."""

    def __init__(self, cells: Iterable[Cell], wrap: bool = False):
        self.cells: dict[str, Cell] = {}
        for cell in cells:
            if cell.kind not in KINDS:
                raise ValueError(f"cell {cell.name}: unknown kind {cell.kind!r}")
            self.cells[cell.name] = cell
        self.wrap = wrap

    def __len__(self) -> int:
        return len(self.cells)

    def __iter__(self):
        return iter(self.cells.values())

    def __getitem__(self, name: str) -> Cell:
        return self.cells[name]

    def names(self, *kinds: str) -> list[str]:
        return [c.name for c in self if not kinds or c.kind in kinds]

    def resolve(self, name: str) -> ResolvedCell:
        """The cell with its refinement chain joined into one condition.

        Conditions are joined as text, root first, so a refinement of ``a OR b`` by
        ``c`` reads ``a OR b AND c`` and binds to the last alternative only. With
        ``wrap=True`` both sides are put in parentheses instead.
        """
        cell = self.cells.get(name)
        if cell is None:
            return ResolvedCell(name, layout.MISSING, problem="no such cell")
        if cell.kind == RATIO:
            return ResolvedCell(name, RATIO, num=cell.num, den=cell.den)

        chain = [cell]
        while chain[-1].kind == REFINE:
            parent = self.cells.get(chain[-1].parent)
            if parent is None:
                return ResolvedCell(name, layout.FAILED, problem=f"no parent {chain[-1].parent}")
            if parent.kind == RATIO:
                return ResolvedCell(name, layout.FAILED, problem=f"parent {parent.name} is a ratio")
            if parent in chain:
                return ResolvedCell(name, layout.FAILED, problem=f"cycle through {parent.name}")
            chain.append(parent)
        root = chain[-1]
        text = root.predicate
        for step in reversed(chain[:-1]):
            if self.wrap:
                text = f"({text}) {step.joiner} ({step.predicate})"
            else:
                text = f"{text} {step.joiner} {step.predicate}"
        return ResolvedCell(
            name,
            root.kind,
            predicate=text,
            value=root.value if root.kind == MEDIAN else None,
            root=root.name,
            depth=len(chain) - 1,
        )

    def select(self, names: Iterable[str] | None = None) -> list[ResolvedCell]:
        """Cells to run, in run order: the whole catalog or the given names once each."""
        wanted = self.cells if names is None else dict.fromkeys(names)
        return [self.resolve(n) for n in wanted]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """Declared cells as a table."""
        rows = [
            (i, c.name, c.kind, c.parent, c.predicate, c.num, c.den, c.note)
            for i, c in enumerate(self)
        ]
        return local_table(
            spark,
            rows,
            "ordinal int, cell string, kind string, parent string, predicate string, "
            "num string, den string, note string",
        )

    def resolved_frame(
        self,
        spark: SparkSession,
        bounds: Mapping[str, dt.date] | None = None,
        names: Iterable[str] | None = None,
    ) -> DataFrame:
        """Dry run: what each cell would evaluate. Nothing is computed on the input."""
        rows = [
            (i, c.name, c.kind, c.root, c.depth, bind(c.predicate, bounds or {}), c.num, c.den, c.problem)
            for i, c in enumerate(self.select(names))
        ]
        return local_table(
            spark,
            rows,
            "ordinal int, cell string, kind string, root string, depth int, predicate string, "
            "num string, den string, problem string",
        )


def bind(predicate: str | None, bounds: Mapping[str, dt.date]) -> str | None:
    """Condition text with its ``:name`` window bounds replaced by date literals."""
    if predicate is None:
        return None
    return _BOUND.sub(
        lambda m: f"DATE '{bounds[m[1]]}'" if m[1] in bounds else m[0], predicate
    )


def bind_columns(predicate: str, names: Iterable[str]) -> str:
    """Condition text whose ``:name`` window bounds are columns of that name."""
    known = set(names)
    return _BOUND.sub(lambda m: m[1] if m[1] in known else m[0], predicate)
