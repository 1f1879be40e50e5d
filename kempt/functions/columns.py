"""Column classes, quoting and the shared notion of a missing cell."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Text that is a number, with blanks around it allowed.
NUMBER = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?))\s*$"


def col(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_categorical(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_categorical(f.dataType)]


def targets(requested: Iterable[str], available: Iterable[str]) -> list[str]:
    """Requested names that are available, in requested order, once each."""
    have = set(available)
    return [name for name in dict.fromkeys(requested) if name in have]


def is_missing(field: T.StructField) -> Column:
    """Null, or NaN where the type has one."""
    c = col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def present(field: T.StructField) -> Column:
    """The value with NaN turned into null, so that aggregates skip both."""
    c = col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def text_of(value: Column, dtype: T.DataType) -> Column:
    """The value as text; booleans read TRUE and FALSE."""
    if is_categorical(dtype):
        return value
    text = value.cast("string")
    return F.upper(text) if isinstance(dtype, T.BooleanType) else text


def as_text(field: T.StructField) -> Column:
    return text_of(present(field), field.dataType)


def number(field: T.StructField) -> Column:
    """The value as a double; text that is no number becomes null, never an error."""
    c = col(field.name)
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")) / F.lit(1e6)
    value = c.try_cast("double")
    if is_categorical(field.dataType):
        # The cast would also read suffixed literals such as 5f.
        value = F.when(c.rlike(NUMBER), value)
    return F.when(~F.isnan(value), value)
