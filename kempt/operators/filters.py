"""Row filters, and the domains a filter can choose from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_text, col, is_numeric, present
from ..functions.names import free_name

LIST_LEVELS = 10_000


@dataclass(frozen=True)
class RowFilter:
    """A range for a numeric column, or a set of levels for any other."""

    column: str | None = None
    range: Sequence[float] | None = None
    levels: Sequence[str] | None = None

    def apply(self, df: DataFrame, list_levels: int = LIST_LEVELS) -> DataFrame:
        field = {f.name: f for f in df.schema.fields}.get(self.column)
        if field is None:
            return df
        c = col(field.name)
        if is_numeric(field.dataType):
            if self.range is None or len(self.range) != 2:
                return df
            # NaN sorts above every number, so no range holds it.
            return df.where(c.between(*self.range))
        if not self.levels:
            return df
        text = as_text(field)
        if len(self.levels) <= list_levels:
            return df.where(text.isin(*self.levels))
        level = free_name("level", df.columns)
        chosen = df.sparkSession.createDataFrame([(v,) for v in set(self.levels)], f"{level} string")
        return df.join(chosen, text == F.col(level), "left_semi")


def numeric_domain(df: DataFrame, column: str, current: Sequence[float] | None = None) -> DataFrame:
    """One row: slider bounds (rounded outwards to 2 places) and the clamped current range."""
    value = present(df.schema[column]).cast("double")
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    low, high = (current if current is not None and len(current) == 2 else (None, None))
    return ends.where(F.col("lo").isNotNull()).select(
        (F.floor(F.col("lo") * 100) / F.lit(100.0)).alias("min"),
        (F.ceil(F.col("hi") * 100) / F.lit(100.0)).alias("max"),
        F.greatest("lo", F.lit(low).cast("double")).alias("from"),
        F.least("hi", F.lit(high).cast("double")).alias("to"),
    )


def level_domain(df: DataFrame, column: str, current: Sequence[str] | None = None) -> DataFrame:
    """The distinct values as text, sorted; with a current selection also which of them are ``selected``.

    A selection without any available level selects them all.
    """
    text = as_text(df.schema[column]).alias("level")
    levels = df.select(text).where(F.col("level").isNotNull()).distinct()
    if current is not None:
        chosen = F.col("level").isin(*current) if current else F.lit(False)
        some = levels.where(chosen).limit(1).count() > 0
        levels = levels.withColumn("selected", chosen if some else F.lit(True))
    return levels.orderBy("level")
