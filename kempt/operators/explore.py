"""The numbers behind insights, correlations and charts: small results, computed in place."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_text, is_numeric, numeric_columns, present
from .counts import modes, text_counts
from .lookup import attach
from .numeric import FENCE
from .quantiles import GROUP_ROWS, grouped_quantiles, quantiles
from .staging import staged

QUARTILES = [0.25, 0.5, 0.75]
BINS = 30    # fixed value: default number of histogram bins
PAIRS_PER_PASS = 400


def _number(df: DataFrame, name: str) -> Column:
    if not is_numeric(df.schema[name].dataType):
        raise ValueError(f"{name!r} is not a numeric column")
    return present(df.schema[name]).cast("double")


def numeric_insight(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """One row: n, mean, median, sd, min, max, q1, q3, skewness (3 places) and missing."""
    x = _number(df, column)
    row = df.agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"),
        F.min(x).alias("min"), F.max(x).alias("max"),
        F.coalesce(F.skewness(x), F.lit(0.0)).alias("skewness"),
        F.count_if(x.isNull()).alias("missing"),
    ).first()
    q1, median, q3 = quantiles(df, {column: x}, QUARTILES, exact, {column: row["n"]})[column]
    out = {**row.asDict(), "q1": q1, "median": median, "q3": q3}
    floats = ["mean", "median", "sd", "min", "max", "q1", "q3", "skewness"]
    fields = ["n bigint", *[f"{f} double" for f in floats], "missing bigint"]
    frame = df.sparkSession.createDataFrame(
        [(out["n"], *[out[f] for f in floats], out["missing"])], ", ".join(fields)
    )
    return frame.select("n", *[F.round(f, 3).alias(f) for f in floats], "missing")


def categorical_insight(df: DataFrame, column: str) -> DataFrame:
    """One row: n, unique, missing, mode (ties: smallest value) and its count."""
    text = as_text(df.schema[column])
    counts = df.groupBy(text.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    there = F.col("v").isNotNull()
    best = F.min(F.when(there, F.struct((-F.col("n")).alias("neg"), F.col("v"))))
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return counts.agg(
        total(there).alias("n"), F.count("v").alias("unique"), total(~there).alias("missing"),
        F.coalesce(best["v"], F.lit("N/A")).alias("mode"),
        F.coalesce(-best["neg"], F.lit(0)).alias("mode_count"),
    )


def insight(df: DataFrame, column: str) -> DataFrame:
    """Numeric insight, or the categorical one where no number is present."""
    if is_numeric(df.schema[column].dataType) and df.where(_number(df, column).isNotNull()).limit(1).count():
        return numeric_insight(df, column)
    return categorical_insight(df, column)


def kurtosis(df: DataFrame, column: str) -> DataFrame:
    x = _number(df, column)
    return df.agg(F.count(x).alias("n"), F.round(F.kurtosis(x), 3).alias("kurtosis"))


def mode_first(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``column, mode, mode_count``; ties go to the value that appears first."""
    found = modes(text_counts(df, columns, order_by))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "number int, column string")
    return names.join(F.broadcast(found), "number", "left").select(
        "column",
        F.coalesce("top", F.lit("Missing")).alias("mode"),
        F.coalesce("top_count", F.lit(0)).alias("mode_count"),
    )


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact: bool = True) -> DataFrame:
    """``column, prob, value`` for each column and probability."""
    found = quantiles(df, {c: _number(df, c) for c in columns}, probs, exact)
    rows = [(c, float(p), v) for c in columns for p, v in zip(probs, found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def correlations(df: DataFrame) -> DataFrame:
    """``x, y, r``: Pearson on the rows where both are present, 2 places, both triangles.

    Columns need two present values that differ. All pairs are aggregates of one pass;
    very wide tables take a few passes over the numeric columns. A pair of columns
    without gaps needs only the sum of products of its standardized values.
    """
    names = numeric_columns(df)
    schema = "x string, y string, r double"
    values = {n: _number(df, n) for n in names}
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[e.alias(f"{k}{i}") for i, x in enumerate(values.values()) for k, e in (
            ("n", F.count(x)), ("mean", F.avg(x)), ("sd", F.stddev_samp(x)), ("varies", F.min(x) < F.max(x)),
        )],
    ).first()
    usable = [i for i in range(len(names)) if row[f"varies{i}"] and row[f"sd{i}"]]
    if len(usable) < 2:
        return df.sparkSession.createDataFrame([], schema)
    scaled = df.select(*[
        ((values[names[i]] - row[f"mean{i}"]) / row[f"sd{i}"]).alias(f"z{i}") for i in usable
    ])
    pairs = list(combinations(usable, 2))
    passes = [pairs[i:i + PAIRS_PER_PASS] for i in range(0, len(pairs), PAIRS_PER_PASS)]
    if len(passes) > 1:
        scaled = staged(scaled, "numeric")
    whole = {i for i in usable if row[f"n{i}"] == row["rows"]}

    def pearson(a: int, b: int) -> Column:
        x, y = F.col(f"z{a}"), F.col(f"z{b}")
        if a in whole and b in whole:
            return F.sum(x * y) / (row["rows"] - 1)
        # Null, not an error, where the shared rows hold a constant.
        paired = lambda u, v: F.when(v.isNotNull(), u)
        spread = F.stddev_samp(paired(x, y)) * F.stddev_samp(paired(y, x))
        return F.try_divide(F.covar_samp(x, y), spread)

    found: dict[tuple[int, int], float | None] = {(i, i): 1.0 for i in usable}
    for group in passes:
        sums = scaled.agg(*[pearson(a, b).alias(f"r{k}") for k, (a, b) in enumerate(group)]).first()
        found |= {pair: sums[k] for k, pair in enumerate(group)}
    rows = [(names[a], names[b], found[min(a, b), max(a, b)]) for a in usable for b in usable]
    return df.sparkSession.createDataFrame(rows, schema).withColumn(
        "r", F.round("r", 2) + F.lit(0.0)    # no negative zero
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """``value, count`` in value order; missing cells are one group of their own."""
    value = present(df.schema[column])
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.asc_nulls_last("value"))


def bar_totals(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Per x (and colour): count, sum, mean, min and max of the present y."""
    value = _number(df, y)
    keys = [present(df.schema[x]).alias("x"), *([present(df.schema[color]).alias("color")] if color else [])]
    return df.groupBy(*keys).agg(
        F.count(value).alias("count"), F.sum(value).alias("sum"), F.avg(value).alias("mean"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )


def histogram(df: DataFrame, x: str, bins: int = BINS, color: str | None = None) -> DataFrame:
    """``bin, bin_start, bin_end, [color,] count``: equal bins, the last one closed.

    A column that is not numeric is counted by value: ``value, [color,] count``.
    """
    shade = [present(df.schema[color]).alias("color")] if color else []
    if not is_numeric(df.schema[x].dataType):
        value = as_text(df.schema[x])
        return df.where(value.isNotNull()).groupBy(value.alias("value"), *shade).agg(F.count(F.lit(1)).alias("count"))
    value = _number(df, x)
    low, high = df.agg(F.min(value), F.max(value)).first()
    number, start, end = _bin(value, low, high, bins)
    counted = df.where(value.isNotNull()).groupBy(number.alias("bin"), *shade).agg(F.count(F.lit(1)).alias("count"))
    return counted.select("bin", start.alias("bin_start"), end.alias("bin_end"), *(["color"] if color else []), "count")


def _bin(value: Column, low: float | None, high: float | None, bins: int):
    low, high = low or 0.0, high or 0.0
    width = (high - low) / bins
    if width == 0:
        return F.lit(1), F.lit(low), F.lit(high)
    number = F.least(F.floor((value - low) / F.lit(width)).cast("int") + 1, F.lit(bins))
    return number, F.lit(low) + (F.col("bin") - 1) * F.lit(width), F.lit(low) + F.col("bin") * F.lit(width)


def _boxed(df: DataFrame, y: str, group: str | None, group_rows: int) -> DataFrame:
    """Every present y as ``g, v`` with the size, quartiles and fences of its group."""
    g = present(df.schema[group]) if group else F.lit("all")
    rows = df.select(g.alias("g"), _number(df, y).alias("v")).where(F.col("v").isNotNull())
    q1, q3 = F.col("q1"), F.col("q3")
    if group is None:
        n = rows.count()
        q = quantiles(rows, {"v": F.col("v")}, QUARTILES, counts={"v": n})["v"]
        literals = dict(zip(("q1", "median", "q3"), (F.lit(v).cast("double") for v in q)))
        boxed = rows.withColumns({"size": F.lit(n), **literals})
    else:
        quartiles = grouped_quantiles(rows, "g", "v", QUARTILES, group_rows).toDF("key", "n", "q1", "median", "q3")
        boxed = attach(rows, F.col("g"), staged(quartiles.withColumn("size", F.col("n")), "boxes"))
    return boxed.withColumns({"lower": q1 - FENCE * (q3 - q1), "upper": q3 + FENCE * (q3 - q1)})


def _same(name: str) -> Column:
    """A value that is the same on all rows of a group."""
    return F.first(name).alias(name)


def box_summary(df: DataFrame, y: str, group: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per group: n, min, quartiles, max, mean, whiskers (extremes inside the fences), outliers."""
    inside = F.col("v").between(F.col("lower"), F.col("upper"))
    return _boxed(df, y, group, group_rows).groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), _same("q1"), _same("median"), _same("q3"),
        F.max("v").alias("max"), F.avg("v").alias("mean"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    ).withColumnRenamed("g", "group")


def box_outliers(df: DataFrame, y: str, group: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``group, value`` of every point outside the fences of its group."""
    outside = ~F.col("v").between(F.col("lower"), F.col("upper"))
    return _boxed(df, y, group, group_rows).where(outside).select(
        F.col("g").alias("group"), F.col("v").alias("value")
    )


def violin_summary(
    df: DataFrame, y: str, group: str | None = None, bins: int = BINS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Per group and bin: count and density, with the group's quartiles and mean."""
    boxed = _boxed(df, y, group, group_rows)
    low, high, mean = boxed.agg(F.min("v"), F.max("v"), F.avg("v")).first()
    number, start, end = _bin(F.col("v"), low, high, bins)
    width = ((high or 0.0) - (low or 0.0)) / bins
    counted = boxed.groupBy("g", number.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), _same("size"), _same("q1"), _same("median"), _same("q3")
    )
    if group is None:
        joined = counted.withColumn("mean", F.lit(mean).cast("double"))
    else:
        # One row per group on the right, at most ``bins`` per group on the left.
        means = boxed.groupBy(F.col("g").alias("_g")).agg(F.avg("v").alias("mean"))
        joined = counted.join(means, F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    density = F.col("count") / (F.col("size") * F.lit(width)) if width else F.lit(None).cast("double")
    return joined.select(
        F.col("g").alias("group"), "bin", start.alias("bin_start"), end.alias("bin_end"), "count",
        density.alias("density"), "q1", "median", "q3", "mean",
    )


def scatter_points(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """Every pair of present x and y, with its colour."""
    shade = [present(df.schema[color]).alias("color")] if color else []
    points = df.select(_number(df, x).alias("x"), _number(df, y).alias("y"), *shade)
    return points.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def has_points(df: DataFrame, x: str, y: str) -> bool:
    return scatter_points(df, x, y).limit(1).count() > 0


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line through the points; null where x does not vary."""
    points = scatter_points(df, x, y)
    slope = F.try_divide(F.covar_pop("y", "x"), F.var_pop("x"))
    return points.agg(
        F.count(F.lit(1)).alias("n"), slope.alias("slope"),
        (F.avg("y") - slope * F.avg("x")).alias("intercept"),
    )
