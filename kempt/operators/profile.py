"""Tables about a table: missing cells, distinct values, summary statistics, stage counts.

One aggregate reads every column once; the long form comes from that single row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import col, is_missing, is_numeric, numeric_columns, present
from .counts import distinct_values, modes, text_counts
from .duplicates import count_duplicates
from .missing import LABEL
from .quantiles import quantiles

STATS = ["rows", "cols", "numeric", "non_numeric", "missing", "duplicates"]


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def _long(df: DataFrame, parts: dict[str, dict[str, Column]]) -> DataFrame:
    """One row per column of ``df`` from one aggregate; ``parts`` maps column -> label -> agg."""
    labels = list(next(iter(parts.values())))
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[e.alias(f"v{i}_{k}") for i, p in enumerate(parts.values()) for k, e in p.items()],
    )
    records = [
        F.struct(
            F.lit(i).alias("number"),
            F.lit(name).alias("column"),
            *[F.col(f"v{i}_{k}").alias(k) for k in labels],
        )
        for i, name in enumerate(parts)
    ]
    return row.select("_rows", F.inline(F.array(*records)))


def missing_columns(df: DataFrame) -> DataFrame:
    """``column, missing, missing_pct, is_numeric`` of the columns that have gaps."""
    return _missing_long(df).where(F.col("missing") > 0).select(
        "column", "missing", "missing_pct", "is_numeric"
    )


def _missing_long(df: DataFrame) -> DataFrame:
    numeric = set(numeric_columns(df))
    long = _long(df, {f.name: {"missing": F.count_if(is_missing(f))} for f in df.schema.fields})
    return long.select(
        "number",
        "column",
        "missing",
        _percent(F.col("missing"), F.col("_rows")).alias("missing_pct"),
        F.col("column").isin(*numeric).alias("is_numeric") if numeric else F.lit(False).alias("is_numeric"),
    )


def missing_labels(df: DataFrame) -> DataFrame:
    """``column, label`` such as ``age (3 missing, 1.5% missing)`` for columns with gaps."""
    # Fixed value: the wording of a label.
    percent = F.regexp_replace(F.col("missing_pct").cast("string"), "\\.0$", "")
    text = F.format_string("%s (%d missing, %s%% missing)", F.col("column"), F.col("missing"), percent)
    return missing_columns(df).select("column", text.alias("label"))


def missing_order(df: DataFrame) -> DataFrame:
    """Columns with gaps, worst first, and their place on an axis that puts the worst last."""
    # One row per column of the table: safe in one task.
    axis = F.row_number().over(Window.orderBy("missing_pct", "column")).cast("int")
    return (
        missing_columns(df)
        .select("column", "missing", "missing_pct", axis.alias("axis_position"))
        .orderBy(F.desc("missing_pct"), "column")
    )


def distinct_counts(df: DataFrame, exact: bool = True) -> DataFrame:
    """``column, unique`` over present values."""
    if not exact:
        approx = _long(df, {f.name: {"unique": F.approx_count_distinct(present(f))} for f in df.schema.fields})
        return approx.select("column", "unique")
    if len(df.columns) == 1:
        # One row, also where no value is present.
        one = distinct_values(df, df.columns).agg(F.coalesce(F.max("unique"), F.lit(0)).alias("unique"))
        return one.select(F.lit(df.columns[0]).alias("column"), "unique")
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "number int, column string")
    # Both sides have at most one row per column of the table.
    found = F.broadcast(distinct_values(df, df.columns))
    return names.join(found, "number", "left").orderBy("number").select(
        "column", F.coalesce("unique", F.lit(0)).alias("unique")
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """``column, dtype, missing, missing_pct, unique`` for every column, in table order."""
    found = F.broadcast(distinct_values(df, df.columns))
    return (
        _missing_long(df)
        .join(found, "number", "left")
        .orderBy("number")
        .select(
            "column",
            _dtype(df).alias("dtype"),
            "missing",
            "missing_pct",
            F.coalesce("unique", F.lit(0)).alias("unique"),
        )
    )


def _dtype(df: DataFrame) -> Column:
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema.fields])
    return types[F.col("number")]


def summary_table(df: DataFrame, order_by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Per column: dtype, missing, unique, and mean, sd, min, median, max or the top value."""
    numeric = {f.name: present(f).cast("double") for f in df.schema.fields if is_numeric(f.dataType)}
    aggregates = {("rows", ""): F.count(F.lit(1))}
    for f in df.schema.fields:
        aggregates["n", f.name] = F.count(present(f))
        if f.name in numeric:
            for label, function in (("mean", F.avg), ("sd", F.stddev_samp), ("min", F.min), ("max", F.max)):
                aggregates[label, f.name] = function(numeric[f.name])
    row = df.agg(*[e.alias(f"a{i}") for i, e in enumerate(aggregates.values())]).first()
    got = dict(zip(aggregates, row))
    medians = quantiles(df, numeric, [0.5], exact=exact, counts={n: got["n", n] for n in numeric})
    rows = [
        (
            i,
            f.name,
            f.dataType.simpleString(),
            got["rows", ""] - got["n", f.name],
            *[got.get((label, f.name)) for label in ("mean", "sd", "min")],
            medians.get(f.name, [None])[0],
            got.get(("max", f.name)),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    table = df.sparkSession.createDataFrame(
        rows,
        "number int, column string, dtype string, missing bigint, "
        "mean double, sd double, min double, median double, max double",
    )
    # Numeric columns need their distinct counts, the others their modes as well.
    place = {name: i for i, name in enumerate(df.columns)}
    others = [n for n in df.columns if n not in numeric]
    parts = []
    for names, found in ((list(numeric), distinct_values), (others, lambda d, n: modes(text_counts(d, n, order_by)))):
        if names:
            number = F.array(*[F.lit(place[n]) for n in names])[F.col("number")]
            got = found(df, names)
            top = F.col("top") if "top" in got.columns else F.lit(None).cast("string")
            parts.append(got.select(number.alias("number"), "unique", top.alias("top")))
    # At most one row per column of the table.
    found = F.broadcast(reduce(DataFrame.unionAll, parts))
    top = F.coalesce("top", F.lit(LABEL))
    if numeric:
        top = F.when(~F.col("column").isin(*numeric), top)
    return (
        table.join(found, "number", "left")
        .orderBy("number")
        .select(
            "column",
            "dtype",
            "missing",
            F.coalesce("unique", F.lit(0)).alias("unique"),
            *[F.round(c, 4).alias(c) for c in ("mean", "sd", "min", "median", "max")],
            top.alias("top"),
        )
    )


def stage_stats(df: DataFrame) -> DataFrame:
    """One row: rows, cols, numeric, non_numeric, missing cells, duplicate rows.

    Rows and cells are counted without a shuffle; for duplicates, only hashes of rows are shuffled.
    """
    numeric, zero = len(numeric_columns(df)), F.lit(0).cast("bigint")
    gaps = sum((is_missing(f).cast("bigint") for f in df.schema.fields), zero)
    cells = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(gaps), zero).alias("missing"))
    copies = count_duplicates(df).select(zero.alias("rows"), zero.alias("missing"), "duplicates")
    both = cells.withColumn("duplicates", zero).unionByName(copies)
    return both.agg(
        F.coalesce(F.sum("rows"), zero).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("cols"),
        F.lit(numeric).cast("bigint").alias("numeric"),
        F.lit(len(df.columns) - numeric).cast("bigint").alias("non_numeric"),
        F.coalesce(F.sum("missing"), zero).alias("missing"),
        F.coalesce(F.sum("duplicates"), zero).alias("duplicates"),
    )


def quick_stats(df: DataFrame) -> DataFrame:
    """As ``stage_stats``, but every count is zero for a table without rows."""
    zero = F.lit(0).cast("bigint")
    return stage_stats(df).select(
        *[F.when(F.col("rows") > 0, F.col(c)).otherwise(zero).alias(c) for c in STATS]
    )


def _cell_stats(df: DataFrame) -> DataFrame:
    """rows, cols, numeric, non_numeric, missing without the shuffle that duplicates need."""
    numeric = len(numeric_columns(df))
    gaps = sum((is_missing(f).cast("bigint") for f in df.schema.fields), F.lit(0).cast("bigint"))
    rows = F.count(F.lit(1))
    zero = F.lit(0).cast("bigint")
    shown = lambda n: F.when(rows > 0, F.lit(n).cast("bigint")).otherwise(zero)
    return df.agg(
        rows.alias("rows"),
        shown(len(df.columns)).alias("cols"),
        shown(numeric).alias("numeric"),
        shown(len(df.columns) - numeric).alias("non_numeric"),
        F.coalesce(F.sum(gaps), zero).alias("missing"),
    )


def compare_stages(before: DataFrame, after: DataFrame) -> DataFrame:
    """``metric, before, after, delta, verdict``; fewer is better for missing cells only."""
    metrics = STATS[:-1]
    both = _cell_stats(before).withColumn("side", F.lit("before")).unionByName(
        _cell_stats(after).withColumn("side", F.lit("after"))
    )
    at = lambda side, m: F.max(F.when(F.col("side") == side, F.col(m)))
    records = [
        F.struct(
            F.lit(m).alias("metric"),
            at("before", m).alias("before"),
            at("after", m).alias("after"),
            (at("after", m) - at("before", m)).alias("delta"),
        )
        for m in metrics
    ]
    gain = F.when(F.col("metric") == "missing", -F.col("delta")).otherwise(F.col("delta"))
    verdict = F.when(gain > 0, "improved").when(gain < 0, "worse").otherwise("neutral")
    one = both.agg(F.array(*records).alias("records"))
    return one.select(F.inline("records")).withColumn("verdict", verdict)


def overview(df: DataFrame) -> DataFrame:
    """One line of text about the table."""
    big = lambda c: F.format_number(F.col(c), 0)
    # The wording of the line, also for a table without rows.
    text = F.format_string(
        "Rows: %s | Columns: %s | Numeric: %d | Non-numeric: %d | Missing values: %s",
        big("rows"), big("cols"), F.col("numeric"), F.col("non_numeric"), big("missing"),
    )
    line = F.when(F.col("rows") == 0, "No rows available.").otherwise(text)
    return _cell_stats(df).select(line.alias("overview"))


def missing_warning(df: DataFrame) -> DataFrame:
    """``missing`` cells that remain, and whether to warn about them."""
    return _cell_stats(df).select("missing", (F.col("missing") > 0).alias("warning"))


def preview(df: DataFrame, n: int = 12, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows (each task passes on at most n)."""
    return df.orderBy(*[col(c) for c in order_by]).limit(n) if order_by else df.limit(n)
