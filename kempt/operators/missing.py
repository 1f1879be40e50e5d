"""Per-column handling of missing cells, fitted in one pass over the table.

Rules act in table order and each sees only the rows that earlier ``drop_rows`` rules
left. Fills never change another column's statistic, so the sequence is exactly: a
statistic of column k over the rows where every ``drop_rows`` column before k is present,
then one filter, then one projection of fills.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_text, col, is_missing, is_numeric, present
from .counts import modes, text_counts
from .quantiles import quantiles

# The strategies a column can choose from, and the label for missing text.
NUMERIC_STRATEGIES = ("keep", "drop_rows", "median", "mean", "zero")
OTHER_STRATEGIES = ("keep", "drop_rows", "mode", "missing_label")
LABEL = "Missing"


def strategies(dtype: T.DataType) -> tuple[str, ...]:
    return NUMERIC_STRATEGIES if is_numeric(dtype) else OTHER_STRATEGIES


@dataclass(frozen=True)
class FillMissing:
    """Fitted: rows to drop, and the value each column is filled with."""

    rules: Mapping[str, str]
    fills: Mapping[str, object]

    @staticmethod
    def fit(
        df: DataFrame,
        rules: Mapping[str, str],
        order_by: Sequence[str] = (),
        exact: bool = True,
    ) -> FillMissing:
        fields = [f for f in df.schema.fields if rules.get(f.name, "keep") != "keep"]
        for f in fields:
            if rules[f.name] not in strategies(f.dataType):
                raise ValueError(
                    f"{rules[f.name]!r} does not suit column {f.name!r}; "
                    f"choose from {', '.join(strategies(f.dataType))}"
                )
        # The value of each column, on the rows its rule gets to see.
        seen: dict[str, Column] = {}
        left = F.lit(True)
        for f in fields:
            seen[f.name] = F.when(left, present(f))
            if rules[f.name] == "drop_rows":
                left = left & ~is_missing(f)

        by_rule = lambda rule: [f.name for f in fields if rules[f.name] == rule]
        fills: dict[str, object] = {name: 0 for name in by_rule("zero")}
        fills |= {name: LABEL for name in by_rule("missing_label")}
        numeric = by_rule("mean") + by_rule("median")
        if numeric:
            row = df.agg(
                *[F.avg(seen[n]).alias(f"m{i}") for i, n in enumerate(numeric)],
                *[F.count(seen[n]).alias(f"n{i}") for i, n in enumerate(numeric)],
            ).first()
            counts = {n: row[f"n{i}"] for i, n in enumerate(numeric)}
            for i, n in enumerate(by_rule("mean")):
                fills[n] = 0.0 if row[f"m{i}"] is None else float(row[f"m{i}"])
            medians = quantiles(
                df, {n: seen[n] for n in by_rule("median")}, [0.5], exact=exact, counts=counts
            )
            fills |= {n: q[0] for n, q in medians.items()}
        modal = by_rule("mode")
        if modal:
            counted = text_counts(df, modal, order_by, seen)
            found = {r["number"]: r["top"] for r in modes(counted).collect()}
            fills |= {n: found.get(i, LABEL) for i, n in enumerate(modal)}
        return FillMissing({f.name: rules[f.name] for f in fields}, fills)

    def apply(self, df: DataFrame) -> DataFrame:
        fields = {f.name: f for f in df.schema.fields}
        dropped = [n for n, rule in self.rules.items() if rule == "drop_rows" and n in fields]
        if dropped:
            df = df.where(reduce(lambda a, b: a & b, [~is_missing(fields[n]) for n in dropped]))
        if not any(n in fields for n in self.fills):
            return df
        return df.select(*[self._filled(f).alias(f.name) for f in df.schema.fields])

    def _filled(self, field: T.StructField) -> Column:
        if field.name not in self.fills:
            return col(field.name)
        value, rule = self.fills[field.name], self.rules[field.name]
        if rule in ("mean", "median"):
            # An all-missing column has no median: it stays as it is.
            return F.coalesce(present(field).cast("double"), F.lit(value).cast("double"))
        if rule == "zero":
            return F.coalesce(present(field), F.lit(0).cast(field.dataType))
        if rule == "mode" and value != LABEL:
            return F.coalesce(col(field.name), F.lit(value).cast(field.dataType))
        return F.coalesce(as_text(field), F.lit(value))


def handle_missing(df, rules, order_by=(), exact=True) -> DataFrame:
    return FillMissing.fit(df, rules, order_by, exact).apply(df)
