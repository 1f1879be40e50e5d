"""Standardize column names and text cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.columns import categorical_columns, col
from ..functions.names import clean_names


def rename_clean(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


@dataclass(frozen=True)
class Standardize:
    """Fitted: which text columns hold nothing but yes/no tokens."""

    yes_no: tuple[str, ...]

    @staticmethod
    def fit(df: DataFrame) -> Standardize:
        named = rename_clean(df)
        names = categorical_columns(named)
        if not names:
            return Standardize(())
        # bool_and skips missing cells and is null where nothing is present.
        row = named.agg(
            *[F.bool_and(text.is_yes_no(col(n))).alias(f"y{i}") for i, n in enumerate(names)]
        ).first()
        return Standardize(tuple(n for i, n in enumerate(names) if row[i]))

    def apply(self, df: DataFrame) -> DataFrame:
        named = rename_clean(df)
        texts = set(categorical_columns(named))
        out = []
        for name in named.columns:
            c = col(name)
            if name in texts:
                c = text.as_yes_no(c) if name in self.yes_no else text.without_missing_tokens(c)
            out.append(c.alias(name))
        return named.select(*out)
