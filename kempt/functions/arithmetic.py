"""Arithmetic of derived columns: doubles in, doubles out, null propagates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRWISE: dict[str, Callable[[Column, Column], Column]] = {
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
    "multiply": lambda a, b: a * b,
    "divide": F.try_divide,
}

SINGLE: dict[str, Callable[[Column], Column]] = {
    "log": lambda a: F.when(a > -1, F.log1p(a)),
    "square": lambda a: a * a,
    "sqrt": lambda a: F.when(a >= 0, F.sqrt(a)),
    "abs": F.abs,
}

OPERATIONS = (*PAIRWISE, *SINGLE)


def clamp(c: Column, low: float, high: float) -> Column:
    """Pull values into [low, high]; null stays null (least/greatest would skip it)."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)
