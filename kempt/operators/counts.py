"""Value counts of many columns in few groupings.

Counting distinct values column by column inside one aggregate would multiply every row
once per column. Here each cell becomes one short row (column number, value), and equal
values are combined before the shuffle. Where only the number of values matters, texts
are represented by digests of fixed width.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.columns import col, is_categorical, present, text_of


WORD = "word"


def _native(value: Column, dtype: T.DataType) -> tuple[str, Column]:
    """The kind of key under which equal values, and only those, are equal, and the value as that key.

    Integers, dates, times and floating numbers share one kind, a whole number of 64 bits; text is its 256-bit digest;
    every other type is its own kind. A floating number's key is the XXH64 of its 8 bytes: that hash only multiplies by
    odd numbers, adds, rotates and shifts-and-xors, so it maps different 8 bytes to different 64 bits.
    """
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return WORD, value.cast("int").cast("bigint") if isinstance(dtype, T.BooleanType) else value.cast("bigint")
    if isinstance(dtype, T.DateType):
        return WORD, F.unix_date(value).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return WORD, F.unix_micros(value)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return WORD, F.when(value.isNotNull(), F.xxhash64(value.cast("double")))
    if is_categorical(dtype):
        return "digest", F.unhex(F.sha2(value, 256))
    if isinstance(dtype, T.MapType):
        return f"sorted {dtype.simpleString()}", F.array_sort(F.map_entries(value))
    return dtype.simpleString(), value


def _same_text(dtype: T.DataType) -> bool:
    """Whether different values of a type always read differently."""
    return is_categorical(dtype) or isinstance(dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType))


def _order_key(order_by: Sequence[str]) -> Column | None:
    """One column stays a plain value, which aggregates faster than a struct."""
    if not order_by:
        return None
    return col(order_by[0]) if len(order_by) == 1 else F.struct(*[col(c) for c in order_by])


def _cells(df: DataFrame, cells: Sequence[Mapping[str, Column]], there: str, key: Column | None = None) -> DataFrame:
    """One row per cell whose field ``there`` is not null, with the cell's fields and the row's ``key``."""
    kept = [key.alias("key")] if key is not None else []
    names = list(cells[0])
    if len(cells) == 1:
        rows = df.select(*[c.alias(n) for n, c in cells[0].items()], *kept)
    else:
        structs = [F.struct(*[c.alias(n) for n, c in cell.items()]) for cell in cells]
        rows = df.select(F.explode(F.array(*structs)).alias("cell"), *kept).select(
            *[F.col(f"cell.{n}").alias(n) for n in names], *["key" for _ in kept]
        )
    return rows.where(F.col(there).isNotNull())


def text_counts(
    df: DataFrame,
    names: Sequence[str],
    order_by: Sequence[str] = (),
    values: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``number`` (place in ``names``), ``value`` as text, its count ``n``, and ``first``.

    ``first`` is the smallest order key that holds the value; without ``order_by`` it is
    the value itself, so that ties go to the smallest value. Missing cells are left out.
    """
    fields = {f.name: f for f in df.schema.fields}
    cells = []
    for i, name in enumerate(names):
        value, dtype = (values or {}).get(name, present(fields[name])), fields[name].dataType
        cell = {"number": F.lit(i), "value": text_of(value, dtype)}
        # Nested values and points in time may read alike; their full form tells them apart.
        full = F.lit(None).cast("string") if _same_text(dtype) else F.md5(F.to_json(F.struct(value.alias("v"))))
        cells.append({**cell, "full": full})
    if all(_same_text(fields[n].dataType) for n in names):
        cells = [{k: c for k, c in cell.items() if k != "full"} for cell in cells]
    key = _order_key(order_by)
    grouped = _cells(df, cells, "value", key).groupBy(*cells[0])
    n = F.count(F.lit(1)).alias("n")
    if key is None:
        return grouped.agg(n).withColumn("first", F.col("value"))
    return grouped.agg(n, F.min("key").alias("first"))


def modes(counts: DataFrame) -> DataFrame:
    """Per column number of ``text_counts``: ``unique`` values, the ``top`` one and its count."""
    best = F.min(F.struct((-F.col("n")).alias("neg"), "first", "value")).alias("best")
    return counts.groupBy("number").agg(F.count(F.lit(1)).alias("unique"), best).select(
        "number", "unique", F.col("best.value").alias("top"), (-F.col("best.neg")).alias("top_count")
    )


def distinct_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``number`` (place in ``names``) and ``unique``; a column without values has no row.

    One scan and one grouping. Whole numbers are marked in bitmaps of 64 neighbours, so that a dense column shuffles a
    64th of its values; a sparse one shuffles no more rows than it has values, so no other form is needed for it. Of any
    other kind, each value is a row with one bit.
    """
    fields = {f.name: f for f in df.schema.fields}
    keys = [_native(present(fields[name]), fields[name].dataType) for name in names]
    types = {kind: key for kind, key in keys if kind != WORD}
    # A cell fills the lane of its kind only.
    empty = {kind: F.when(F.lit(False), key) for kind, key in types.items()}
    cells = []
    for i, (own, key) in enumerate(keys):
        one, word = F.lit(1).cast("bigint"), own == WORD
        bit = F.call_function("shiftleft", one, key.bitwiseAND(F.lit(63)).cast("int")) if word else one
        cells.append({
            "number": F.lit(i),
            "bits": F.when(key.isNotNull(), bit),
            "block": F.shiftright(key, 6) if word else F.lit(None).cast("bigint"),
            **{f"lane{k}": key if kind == own else empty[kind] for k, kind in enumerate(types)},
        })
    groups = [name for name in cells[0] if name != "bits"]
    marked = _cells(df, cells, "bits").groupBy(*groups).agg(F.bit_or("bits").alias("marks"))
    return marked.groupBy("number").agg(F.sum(F.bit_count("marks")).cast("bigint").alias("unique"))
