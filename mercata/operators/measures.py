"""Group measures that are taken in two levels, each defined once for all marts.

``summarise`` first groups the fact lines by (group, order, ...), keeping for every
measure the parts it needs (sums, counts, extremes), and then combines the parts
per group.  The first level runs with map-side partial aggregation and leaves one
row per order of a group, so distinct counts work on orders, never on copies of
every fact line.

Where an order has hardly more than one line in a group (products), that first level would be as
long as the fact and several times as wide: ``summarise_apart`` groups the saved lines directly, and
counts distinct orders over the bare (group, order) pairs.

Sums of doubles are kept as integer limbs (``functions.exact``) over both levels, so
totals and means do not depend on how the lines are spread or in which order they come.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions.exact import from_limbs, is_inexact, limbs, outside
from mercata.operators import keys

Parts = Mapping[str, Callable[[], Column]]  # part name -> aggregate over fact lines
Totals = Mapping[str, Callable[[], Column]]  # summed column -> its total over the parts of a group


@dataclass(frozen=True)
class Measure:
    """``combine`` makes the result from the parts of a group and the totals of the ``sums`` columns."""
    combine: Callable[[Totals], Column]
    parts: Parts = field(default_factory=dict)
    sums: tuple[str, ...] = ()
    counts: str | None = None  # column of the first level's grain that is counted distinctly


def _sum_parts(value: str, inexact: bool) -> tuple[Parts, Callable[[], Column]]:
    """First-level parts of a column's sum, and the total they give."""
    part = f"__sum_{value}"
    if not inexact:
        return {part: lambda: F.sum(value)}, lambda: F.sum(part)
    names = [f"{part}_{i}" for i in range(len(limbs(value)))]
    rest = f"{part}_rest"
    parts: dict[str, Callable[[], Column]] = {n: (lambda i=i: F.sum(limbs(value)[i])) for i, n in enumerate(names)}
    parts[rest] = lambda: F.sum(outside(value))
    return parts, lambda: from_limbs([F.sum(n) for n in names], F.sum(rest))


def total(value: str) -> Measure:
    """Sum, in the type that one sum of the lines has."""
    return Measure(lambda t: t[value](), sums=(value,))


def average(value: str) -> Measure:
    """Mean of the non-NULL values: exact sum over count, one division in double."""
    n = f"__count_{value}"
    return Measure(lambda t: F.try_divide(t[value]().cast("double"), F.sum(n)), {n: lambda: F.count(value)}, (value,))


def smallest(value: str) -> Measure:
    part = f"__min_{value}"
    return Measure(lambda _: F.min(part), {part: lambda: F.min(value)})


def largest(value: str) -> Measure:
    part = f"__max_{value}"
    return Measure(lambda _: F.max(part), {part: lambda: F.max(value)})


def distinct(key: str) -> Measure:
    """Exact distinct count of a column of the first level's grain."""
    return Measure(lambda _: F.count_distinct(key), counts=key)


def _parts(lines: DataFrame, measures: Mapping[str, Measure]) -> tuple[Parts, Totals]:
    """First-level parts of all ``measures``, and the totals they give."""
    kind = {f.name: f.dataType for f in lines.schema.fields}
    parts: dict[str, Callable[[], Column]] = {}
    totals: dict[str, Callable[[], Column]] = {}
    for m in measures.values():
        parts |= m.parts
        for value in m.sums:
            added, totals[value] = _sum_parts(value, is_inexact(kind[value]))
            parts |= added
    return parts, totals


def summarise(lines: DataFrame, by: Sequence[str], grain: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """``measures`` per ``by``; ``grain`` are the columns that are counted distinctly.

    With a grain of one column the first level has one row per value of it and group: a plain
    count of the rows is the distinct count.
    """
    parts, totals = _parts(lines, measures)
    groups = lines.groupBy(*by, *grain)
    first = groups.agg(*[make().alias(name) for name, make in parts.items()]) if parts else lines.select(*by, *grain).distinct()
    plain = {name for name, m in measures.items() if m.counts is not None and list(grain) == [m.counts]}
    return first.groupBy(*by).agg(*[F.count(m.counts).alias(name) if name in plain else _combined(name, m, totals, first) for name, m in measures.items()])


def _combined(name: str, m: Measure, totals: Totals, first: DataFrame) -> Column:
    """A measure from the parts in ``first``, in the type that one sum of the lines has."""
    part = f"__sum_{m.sums[0]}" if m.sums and not m.parts else None
    col = m.combine(totals)
    return (col.cast(first.schema[part].dataType) if part in first.columns else col).alias(name)


def summarise_apart(lines: DataFrame, by: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """The rows of ``summarise``, for groups in which an order has hardly more than one line.

    The lines are saved, so that their plan runs once.  Sums, counts and extremes are grouped by
    ``by`` at once: what a task holds and shuffles follows its groups, not its lines.  For the
    distinct counts only pairs of a group and the counted column are moved.
    """
    return _apart(keys.saved(lines, "lines"), by, measures)


def summarised_apart(lines: DataFrame, by: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """``summarise_apart`` with its groups saved: the lines, as many as the fact has, are deleted."""
    rows = keys.saved(lines, "lines")
    out = keys.saved(_apart(rows, by, measures), "groups")
    keys.discard_saved(rows)
    return out


def _apart(rows: DataFrame, by: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    plain = {name: m for name, m in measures.items() if m.counts is None}
    parts, totals = _parts(rows, plain)
    first = rows.groupBy(*by).agg(*[make().alias(name) for name, make in parts.items()])
    out = first.groupBy(*by).agg(*[_combined(name, m, totals, first) for name, m in plain.items()])
    for name, m in measures.items():
        if m.counts is not None:
            of = {b: f"__of_{b}" for b in by}
            pairs = rows.select(*[F.col(b).alias(of[b]) for b in by], F.col(m.counts).alias(name)).distinct()
            counted = pairs.groupBy(*of.values()).agg(F.count(name).alias(name))
            same = reduce(and_, [F.col(b).eqNullSafe(F.col(of[b])) for b in by])
            out = out.join(counted, same).drop(*of.values())
    return out.select(*by, *measures)
