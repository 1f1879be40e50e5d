"""Outliers and scaling of numeric columns: one fit for all columns, one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import clamp
from ..functions.columns import numeric_columns, present, targets
from .quantiles import quantiles

# The fences of the interquartile rule, and the least count it needs.
FENCE = 1.5
LEAST_COUNT = 4


def fences(q1: float | None, q3: float | None, n: int) -> tuple[float, float] | None:
    """Lower and upper fence, or None where the rule does not apply."""
    if n < LEAST_COUNT or q1 is None or q3 is None or q3 == q1:
        return None
    return q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1)


@dataclass(frozen=True)
class Outliers:
    method: str
    columns: tuple[str, ...]
    fences: Mapping[str, tuple[float, float]]

    @staticmethod
    def fit(df: DataFrame, method: str, columns: Sequence[str], exact: bool = True) -> Outliers:
        if method not in ("none", "cap", "remove"):
            raise ValueError(f"unknown outlier method: {method!r}")
        names = targets(columns, numeric_columns(df)) if method != "none" else []
        if not names:
            return Outliers(method, (), {})
        values = _values(df, names)
        counts = _counts(df, values)
        quartiles = quantiles(df, values, [0.25, 0.75], exact=exact, counts=counts)
        found = {n: fences(q[0], q[1], counts[n]) for n, q in quartiles.items()}
        return Outliers(method, tuple(names), {n: f for n, f in found.items() if f})

    def apply(self, df: DataFrame) -> DataFrame:
        fields = {f.name: f for f in df.schema.fields}
        names = [n for n in self.columns if n in fields]
        if not names:
            return df
        if self.method == "remove":
            tests = []
            for n in names:
                if n in self.fences:
                    value = present(fields[n])
                    tests.append(value.isNull() | value.between(*self.fences[n]))
            return df.where(reduce(lambda a, b: a & b, tests)) if tests else df
        capped = {}
        for n in names:
            value = present(fields[n]).cast("double")
            capped[n] = clamp(value, *self.fences[n]) if n in self.fences else value
        return df.withColumns(capped)


@dataclass(frozen=True)
class Scaling:
    method: str
    columns: Mapping[str, tuple[float, float]]    # centre and spread; spread 0 = constant

    @staticmethod
    def fit(df: DataFrame, method: str, columns: Sequence[str], exact: bool = True) -> Scaling:
        if method not in ("none", "standard", "minmax", "robust"):
            raise ValueError(f"unknown scaling method: {method!r}")
        names = targets(columns, numeric_columns(df)) if method != "none" else []
        if not names:
            return Scaling(method, {})
        values = _values(df, names)
        if method == "robust":
            found = quantiles(df, values, [0.25, 0.5, 0.75], exact=exact)
            pairs = {n: (q[1], q[2] - q[0]) for n, q in found.items() if q[1] is not None}
            return Scaling(method, pairs)
        centre, spread = (
            (F.avg, F.stddev_samp) if method == "standard" else (F.min, lambda c: F.max(c) - F.min(c))
        )
        row = df.agg(
            *[centre(c).alias(f"c{i}") for i, c in enumerate(values.values())],
            *[spread(c).alias(f"s{i}") for i, c in enumerate(values.values())],
        ).first()
        return Scaling(
            method,
            {n: (row[f"c{i}"], row[f"s{i}"] or 0.0) for i, n in enumerate(names) if row[f"c{i}"] is not None},
        )

    def apply(self, df: DataFrame) -> DataFrame:
        fields = {f.name: f for f in df.schema.fields}
        scaled = {}
        for n, (centre, spread) in self.columns.items():
            if n not in fields:
                continue
            value = present(fields[n]).cast("double")
            scaled[n] = (
                F.when(value.isNotNull(), F.lit(0.0)) if spread == 0 else (value - centre) / spread
            )
        return df.withColumns(scaled) if scaled else df


def _values(df: DataFrame, names: Sequence[str]):
    fields = {f.name: f for f in df.schema.fields}
    return {n: present(fields[n]).cast("double") for n in names}


def _counts(df: DataFrame, values) -> dict[str, int]:
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(values.values())]).first()
    return {n: row[i] for i, n in enumerate(values)}
