"""Nested objects become dotted top-level columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import uniquify


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name)


def flatten(df: DataFrame) -> DataFrame:
    if not any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        return df
    quoted = lambda path: ".".join("`" + part.replace("`", "``") + "`" for part in path)
    leaves = list(_leaves(df.schema))
    names = uniquify([".".join(p) for p in leaves])
    return df.select(*[F.col(quoted(p)).alias(n) for p, n in zip(leaves, names, strict=True)])
