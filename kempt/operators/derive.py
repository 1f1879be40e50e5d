"""Derived columns from an ordered list of rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from ..functions.arithmetic import OPERATIONS, PAIRWISE, SINGLE
from ..functions.columns import is_numeric, number
from ..functions.names import BLANKS, clean_name, free_name


@dataclass(frozen=True)
class FeatureRule:
    name: str
    operation: str
    col1: str
    col2: str | None = None


def apply_rules(df: DataFrame, rules: Sequence[FeatureRule]) -> DataFrame:
    """Apply rules in order; one that lacks an input, or names no operation, is skipped.

    Rules that do not read one another share one projection.
    """
    batch: dict[str, tuple[str, Column]] = {}
    fields = _by_name(df)
    for rule in rules:
        first, second, name = (n.lower() if n is not None else None for n in (rule.col1, rule.col2, rule.name))
        if {first, second, name} & set(batch):
            df, batch = df.withColumns(dict(batch.values())), {}
            fields = _by_name(df)
        if first not in fields:
            continue
        if rule.operation in PAIRWISE and second in fields:
            value = PAIRWISE[rule.operation](number(fields[first]), number(fields[second]))
        elif rule.operation in SINGLE:
            value = SINGLE[rule.operation](number(fields[first]))
        else:
            continue
        batch[name] = (fields[name].name if name in fields else rule.name, value)
    return df.withColumns(dict(batch.values())) if batch else df


def _by_name(df: DataFrame) -> dict[str, T.StructField]:
    """Columns by lower-cased name, as the engine resolves names."""
    return {f.name.lower(): f for f in df.schema.fields}


def add_rule(
    rules: Sequence[FeatureRule],
    schema,
    operation: str,
    col1: str,
    col2: str | None = None,
    name: str | None = None,
) -> tuple[FeatureRule, ...]:
    """A new rule list with one rule more. Inputs are numeric columns or earlier rules."""
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation: {operation!r}; choose from {', '.join(OPERATIONS)}")
    numeric = {f.name for f in schema.fields if is_numeric(f.dataType)} | {r.name for r in rules}
    if col1 not in numeric:
        raise ValueError(f"{col1!r} is not a numeric column")
    if operation in PAIRWISE and col2 not in numeric:
        raise ValueError(f"{col2!r} is not a numeric column")
    default = f"{col1}_{operation}_{col2}" if operation in PAIRWISE else f"{operation}_{col1}"
    wanted = clean_name((name or "").strip(BLANKS) or default)
    existing = [*schema.names, *(r.name for r in rules)]
    second = col2 if operation in PAIRWISE else None
    return (*rules, FeatureRule(free_name(wanted, existing), operation, col1, second))


def remove_rule(rules: Sequence[FeatureRule], index: int) -> tuple[FeatureRule, ...]:
    """A new rule list without rule ``index`` (from 0); an index past the end changes nothing."""
    return tuple(r for i, r in enumerate(rules) if i != index)
