"""Exact quantiles with linear interpolation, whole columns at any size.

The ``percentile`` aggregate keeps every distinct value in one task. Here each wanted
order statistic is searched for. A round takes approximate percentiles of the values
inside its bracket, on both sides of the wanted place, and then counts exactly how many
values of the whole column lie below and at these split points. Neither step shuffles
rows. The error of the approximation is bounded, so a bracket shrinks to a few ten-thousandths:
one round up to billions of values, two up to 10^12. Then the bracket, or a small column at
once, is sorted. A poor guess would cost another round; it cannot change the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .running import ROWS_PER_TASK, running_total

SORT_ROWS = 500_000            # values of one bracket that one task may sort
GROUP_ROWS = 5_000_000         # a group up to this size may be sorted by one task
ACCURACY = 10_000              # an approximate percentile is off by one part in so many


def quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probs: Sequence[float],
    exact: bool = True,
    counts: Mapping[str, int] | None = None,
    sort_rows: int = SORT_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles of several columns; null and NaN must already be null in ``values``."""
    names = list(values)
    if not names:
        return {}
    table = df.select(*[values[n].cast("double").alias(f"q{i}") for i, n in enumerate(names)])
    column = {n: F.col(f"q{i}") for i, n in enumerate(names)}
    if not exact:
        row = table.agg(*[F.percentile_approx(c, list(probs), 10_000) for c in column.values()]).first()
        return {n: list(row[i]) if row[i] else [None] * len(probs) for i, n in enumerate(names)}
    if counts is None:
        row = table.agg(*[F.count(c) for c in column.values()]).first()
        counts = dict(zip(names, row))
    some = {n: c for n, c in column.items() if counts[n]}
    return {n: [None] * len(probs) for n in names} | _search(table, some, counts, probs, sort_rows)


@dataclass
class _Target:
    """One order statistic of a column; it lies strictly between ``low`` and ``high``."""

    column: str
    rank: int                    # from 0, among all present values
    size: int                    # how many values are inside the bracket
    before: int = 0              # how many values are at or below ``low``
    low: float | None = None
    high: float | None = None
    value: float | None = None

    @property
    def bracket(self) -> tuple[str, float | None, float | None]:
        return self.column, self.low, self.high


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    position = (n - 1) * p
    low = math.floor(position)
    return low, min(low + 1, n - 1), position - low


def _search(table, column, counts, probs, sort_rows) -> dict[str, list[float]]:
    targets: dict[tuple[str, int], _Target] = {}
    for name in column:
        for p in probs:
            for rank in _ranks(counts[name], p)[:2]:
                targets[name, rank] = _Target(name, rank, counts[name])
    while large := [t for t in targets.values() if t.value is None and t.size > sort_rows]:
        places: dict[tuple, set[float]] = {}
        for t in large:
            middle, margin = (t.rank - t.before + 0.5) / t.size, 2 / ACCURACY
            places.setdefault(t.bracket, set()).update((max(middle - margin, 0.0), min(middle + margin, 1.0)))
        cuts = _guess(table, column, places)
        placed = _count_at(table, column, cuts)
        for t in large:
            _narrow(t, placed.get(t.column, []))
    _sort(table, column, [t for t in targets.values() if t.value is None])
    out = {}
    for name in column:
        out[name] = []
        for p in probs:
            low, high, part = _ranks(counts[name], p)
            a, b = targets[name, low].value, targets[name, high].value
            out[name].append(a if a == b else a * (1 - part) + b * part)
    return out


def _inside(c: Column, low: float | None, high: float | None) -> Column:
    test = c.isNotNull()
    if low is not None:
        test = test & (c > low)
    if high is not None:
        test = test & (c < high)
    return test


def _any(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _cells(table: DataFrame, numbered: Sequence[tuple[Column, Column]]) -> DataFrame:
    """``number, value``: one row per pair (test, value) whose test holds."""
    cells = [
        F.struct(F.lit(i).alias("number"), F.when(test, value).alias("value"))
        for i, (test, value) in enumerate(numbered)
    ]
    held = table.where(_any(test for test, _ in numbered))
    rows = held.select(F.explode(F.array(*cells)).alias("c")).select("c.number", "c.value")
    return rows.where(F.col("value").isNotNull())


def _guess(table, column, places: dict[tuple, set[float]]) -> dict[str, list[float]]:
    """Values of each column near the given places of its brackets, from one aggregate."""
    row = table.agg(*[
        F.percentile_approx(F.when(_inside(column[name], low, high), column[name]), sorted(wanted), ACCURACY)
        for (name, low, high), wanted in places.items()
    ]).first()
    cuts: dict[str, set[float]] = {}
    for (name, _, _), values in zip(places, row):
        cuts.setdefault(name, set()).update(values or ())
    return {name: sorted(values) for name, values in cuts.items()}


def _count_at(table, column, cuts: dict[str, list[float]]) -> dict[str, list[tuple[float, int, int]]]:
    """For each cut of each column: how many values of the column are below it, and at it."""
    row = iter(table.agg(*[
        F.count_if(test) for name, values in cuts.items() for cut in values
        for test in (column[name] < cut, column[name] == cut)
    ]).first())
    return {name: [(cut, next(row), next(row)) for cut in values] for name, values in cuts.items()}


def _narrow(t: _Target, cuts: Iterable[tuple[float, int, int]]) -> None:
    """Shrink the bracket. The cuts are values inside it, so it always gets smaller."""
    end = t.before + t.size
    for cut, below, at in cuts:
        if below <= t.rank < below + at:
            t.value = cut
        elif below + at <= t.rank and below + at > t.before:
            t.low, t.before = cut, below + at
        elif below > t.rank and below < end:
            t.high, end = cut, below
    t.size = end - t.before


def _sort(table, column, targets: Sequence[_Target]) -> None:
    """Sort the values inside each bracket, one bracket per task, and pick the ranks."""
    if not targets:
        return
    wanted: dict[tuple, list[_Target]] = {}
    for t in targets:
        wanted.setdefault(t.bracket, []).append(t)
    tests = [(_inside(column[name], low, high), column[name]) for name, low, high in wanted]
    place = F.row_number().over(Window.partitionBy("number").orderBy("value")) - 1
    picks = _any(
        (F.col("number") == i) & F.col("place").isin(*{t.rank - t.before for t in members})
        for i, members in enumerate(wanted.values())
    )
    rows = _cells(table, tests).withColumn("place", place).where(picks).collect()
    found = {(r["number"], r["place"]): r["value"] for r in rows}    # one row per target
    for i, members in enumerate(wanted.values()):
        for t in members:
            t.value = found[i, t.rank - t.before]


def grouped_quantiles(
    df: DataFrame,
    group: str,
    value: str,
    probs: Sequence[float],
    group_rows: int = GROUP_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per group: ``group, n, q0, q1, ...``; null values must be filtered out.

    Where a count proves every group small, each group is sorted by one task. Otherwise
    the distinct values are range-sorted with their counts, so that one hot group spreads
    over many tasks.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= group_rows:
        whole = Window.partitionBy(group)
        ranked = df.select(
            group,
            value,
            F.lit(1).alias("times"),
            (F.row_number().over(whole.orderBy(value)) - 1).alias("before"),
            F.count(F.lit(1)).over(whole).alias("n"),
        )
    else:
        distinct = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("times"))
        ranked = running_total(distinct, [group], [value], F.col("times"), rows_per_task=rows_per_task).join(
            sizes.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "inner"
        ).drop("_g")

    def at(rank: Column) -> Column:
        hit = (F.col("before") <= rank) & (rank < F.col("before") + F.col("times"))
        return F.max(F.when(hit, F.col(value)))

    picks, mixed = [], []
    for i, p in enumerate(probs):
        position = (F.col("n") - 1) * F.lit(float(p))
        low = F.floor(position)
        picks += [
            at(low).alias(f"_low{i}"),
            at(F.least(low + 1, F.col("n") - 1)).alias(f"_high{i}"),
            F.max(position - low).alias(f"_part{i}"),
        ]
        a, b, part = (F.col(f"_{k}{i}") for k in ("low", "high", "part"))
        mixed.append(F.when(a == b, a).otherwise(a * (1 - part) + b * part).alias(f"q{i}"))
    return ranked.groupBy(group).agg(F.max("n").alias("n"), *picks).select(group, "n", *mixed)
