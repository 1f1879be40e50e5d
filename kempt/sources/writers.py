"""Write a table as CSV."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_text, col
from .readers import CSV_MISSING


def dated_name(today: date | None = None) -> str:
    # Fixed value: how exported files are named.
    return f"processed_data_{(today or date.today()).isoformat()}.csv"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of part files, each with a header; missing cells are written as NA."""
    out = df.select(*[_cell(f).alias(f.name) for f in df.schema.fields])
    out.write.mode(mode).csv(
        path, header=True, nullValue=CSV_MISSING, emptyValue='""', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def _cell(field: T.StructField):
    """Booleans as TRUE and FALSE; NaN, like null, as missing."""
    c = col(field.name)
    if isinstance(field.dataType, T.BooleanType):
        return as_text(field)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c
