"""Label and one-hot encoding of text columns.

Levels are numbered by first appearance, that is by the smallest order key that holds
them; without an order key, by value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.columns import categorical_columns, col, targets
from ..functions.names import clean_name, free_name, uniquify
from .counts import text_counts
from .lookup import ROW_BYTES, attach
from .missing import LABEL
from .running import ROWS_PER_TASK, running_total
from .staging import staged

INLINE_LEVELS = 24        # up to here a code is found inside the projection
QUICK_LEVELS = 1_000      # levels of all columns that are fetched without writing them first
DRIVER_LEVELS = 10_000    # levels of a column that the driver may hold,
DRIVER_LENGTH = 500       # and how many bytes each of them may have
TASK_BYTES = 64 * 1024 * 1024    # of the levels that one task ranks
NAME_BYTES = 16 * 1024 * 1024    # of the levels that become column names


def _filled(name: str) -> Column:
    return F.coalesce(col(name), F.lit(LABEL))


def _levels(df: DataFrame, names: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return text_counts(df, names, order_by, {n: _filled(n) for n in names})


Found = dict[int, list[tuple[str, int]]]


def _quick(levels: DataFrame, order_by: Sequence[str]) -> Found | None:
    """The ranked levels (value, n) of each column number in one job, or None where they may be many or long.

    A task passes on at most ``QUICK_LEVELS`` + 1 short rows; nothing is written.
    """
    keys = levels.schema["first"].dataType
    keys = [f.dataType for f in keys.fields] if isinstance(keys, T.StructType) else [keys]
    if order_by and not all(isinstance(k, (T.NumericType, T.DatetimeType, T.BooleanType)) for k in keys):
        return None    # such keys may be long
    short = F.when(F.octet_length("value") <= DRIVER_LENGTH, F.col("value"))
    first = F.col("first") if order_by else F.lit(0)
    rows = levels.select("number", first.alias("first"), short.alias("value"), "n")
    rows = rows.orderBy("number", "first", "value").limit(QUICK_LEVELS + 1).select("number", "value", "n").collect()
    if len(rows) > QUICK_LEVELS or any(r["value"] is None for r in rows):
        return None
    found: Found = {}
    for r in rows:
        found.setdefault(r["number"], []).append((r["value"], r["n"]))
    return found


def _sizes(levels: DataFrame) -> Mapping[int, Mapping[str, int]]:
    """How many ``levels`` each column number has, the bytes of the ``longest`` and of all."""
    length = F.octet_length("value")
    sizes = levels.groupBy("number").agg(
        F.count(F.lit(1)).alias("levels"), F.max(length).alias("longest"), F.sum(length).alias("bytes")
    )
    return {r["number"]: r.asDict() for r in sizes.collect()}


def _ranked(levels: DataFrame, numbers: Sequence[int]) -> Found:
    """The levels of columns proven small, as (value, n), ranked by the engine; their keys stay there."""
    if not numbers:
        return {}
    place = F.row_number().over(Window.partitionBy("number").orderBy("first", "value"))
    rows = levels.where(F.col("number").isin(*numbers)).select("number", "value", "n", place.alias("place")).collect()
    out: Found = {}
    for r in sorted(rows, key=lambda r: (r["number"], r["place"])):
        out.setdefault(r["number"], []).append((r["value"], r["n"]))
    return out


@dataclass(frozen=True)
class LabelEncode:
    """Fitted: the level list of each column, or its dictionary table where that is long, with its rows and bytes."""

    lists: Mapping[str, Sequence[str]] = field(default_factory=dict)
    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    sizes: Mapping[str, tuple[int, int]] = field(default_factory=dict)

    @staticmethod
    def fit(
        df: DataFrame,
        columns: Sequence[str],
        order_by: Sequence[str] = (),
        driver_levels: int = DRIVER_LEVELS,
        rows_per_task: int = ROWS_PER_TASK,
    ) -> LabelEncode:
        names = targets(columns, categorical_columns(df))
        if not names:
            return LabelEncode()
        levels = _levels(df, names, order_by).select("number", "value", "n", "first")
        sizes: Mapping[int, Mapping[str, int]] = {}
        found = _quick(levels, order_by)
        if found is None or any(len(one) > driver_levels for one in found.values()):
            # Written once; then each column goes its own way, with the same order of levels.
            levels = staged(levels, "levels")
            sizes = _sizes(levels)
            found = _ranked(levels, [
                i for i, size in sizes.items() if size["levels"] <= driver_levels and size["longest"] <= DRIVER_LENGTH
            ])
        lists, tables, held = {}, {}, {}
        for i, one in found.items():
            if len(one) <= INLINE_LEVELS:
                lists[names[i]] = tuple(value for value, _ in one)
            else:
                tables[names[i]] = df.sparkSession.createDataFrame(
                    [(value, n, code) for code, (value, n) in enumerate(one, 1)], "key string, n bigint, code int"
                )
                held[names[i]] = len(one), sum(len(value.encode()) for value, _ in one)
        for i in set(sizes) - set(found):
            # Long dictionaries never reach the driver: they are ranked where they are.
            one = levels.where(F.col("number") == i).select("value", "n", "first")
            fitting = max(1, sizes[i]["levels"] * TASK_BYTES // max(1, sizes[i]["bytes"]))
            ranked = running_total(
                one, [], ["first", "value"], rows=sizes[i]["levels"], rows_per_task=min(rows_per_task, fitting)
            )
            code = (F.col("before") + 1).cast("int")
            tables[names[i]] = staged(ranked.select(F.col("value").alias("key"), "n", code.alias("code")), "codes")
            held[names[i]] = sizes[i]["levels"], sizes[i]["bytes"]
        return LabelEncode(lists, tables, held)

    def apply(self, df: DataFrame) -> DataFrame:
        names = df.columns
        codes = {
            n: F.nullif(
                F.array_position(F.array(*[F.lit(v) for v in levels]), _filled(n)), F.lit(0)
            ).cast("int")
            for n, levels in self.lists.items()
            if n in names
        }
        if codes:
            df = df.withColumns(codes)
        for name, table in self.tables.items():
            if name in names:
                code = free_name("code", names)
                rows, size = self.sizes[name]
                df = attach(df, _filled(name), table.withColumnRenamed("code", code), size=rows * (ROW_BYTES + 16) + size)
                df = df.select(*[F.col(code).alias(c) if c == name else col(c) for c in names])
        return df


class TooManyLevels(ValueError):
    """One-hot encoding would add more columns than allowed; nothing is cut off silently."""


def _refuse(names: Sequence[str], counts: Mapping[int, int], max_levels: int | None) -> None:
    for i, count in counts.items():
        if max_levels is not None and count > max_levels:
            raise TooManyLevels(f"{names[i]!r} has over {max_levels} levels; raise max_levels or label-encode it")


@dataclass(frozen=True)
class OneHotEncode:
    """Fitted: the levels of each column, in the order of their indicator columns.

    ``max_levels``, off unless set, refuses columns with more levels; levels are never cut off. Levels that take over
    ``NAME_BYTES`` cannot be column names: they are refused after they were counted; ``SparseOneHot`` takes them.
    """

    levels: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @staticmethod
    def fit(
        df: DataFrame, columns: Sequence[str], order_by: Sequence[str] = (), max_levels: int | None = None
    ) -> OneHotEncode:
        names = targets(columns, categorical_columns(df))
        if not names:
            return OneHotEncode()
        levels = _levels(df, names, order_by).select("number", "value", "n", "first")
        found = _quick(levels, order_by)
        if found is None:
            levels = staged(levels, "levels")
            sizes = _sizes(levels)
            _refuse(names, {i: size["levels"] for i, size in sizes.items()}, max_levels)
            names_bytes = sum(size["bytes"] for size in sizes.values())
            if names_bytes > NAME_BYTES:
                raise TooManyLevels(f"names of {names_bytes} bytes for the columns to add; use SparseOneHot")
            # Levels become column names, so they, and only they, reach the driver.
            found = _ranked(levels, list(sizes))
        else:
            _refuse(names, {i: len(one) for i, one in found.items()}, max_levels)
        return OneHotEncode({names[i]: tuple(value for value, _ in found[i]) for i in sorted(found)})

    def apply(self, df: DataFrame) -> DataFrame:
        sources = [n for n in self.levels if n in df.columns]
        if not sources:
            return df
        others = [c for c in df.columns if c not in sources]
        pairs = [(n, level) for n in sources for level in self.levels[n]]
        names = uniquify([clean_name(f"{n}_{level}") for n, level in pairs], reserved=others)
        indicators = [
            (_filled(n) == level).cast("int").alias(name) for (n, level), name in zip(pairs, names)
        ]
        return df.select(*[col(c) for c in others], *indicators)


def _digested(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.sha2(_filled(n), 256) for n in names}) if names else df


@dataclass(frozen=True)
class SparseOneHot:
    """One-hot encoding for any number of levels, as one column that lists the indicators which are 1.

    The indicators of all encoded columns are numbered from 0: first those of the first column, in the order of its
    levels, then those of the next. A row lists one number per encoded column, none for a level that was not fitted.
    Long dictionaries are ranked and joined in the cluster; the driver holds only how many levels each column has.
    A column with a level of over ``DRIVER_LENGTH`` bytes is ``digested``: the SHA-256 of its values, in hexadecimal,
    stand for them everywhere, so that no long text is shuffled or stored. They also stand for them where levels are
    ordered by value: without ``order_by``, or where two levels first appear at the same key.
    """

    labels: LabelEncode
    offsets: Mapping[str, int]
    width: int
    digested: Sequence[str] = ()

    @staticmethod
    def fit(
        df: DataFrame, columns: Sequence[str], order_by: Sequence[str] = (), driver_levels: int = DRIVER_LEVELS
    ) -> SparseOneHot:
        names = targets(columns, categorical_columns(df))
        lengths = df.agg(F.lit(0), *[F.max(F.octet_length(col(n))) for n in names]).first()[1:]
        digested = tuple(n for n, longest in zip(names, lengths) if (longest or 0) > DRIVER_LENGTH)
        # Keys of the order stay what they are, also where such a column is encoded.
        keys = {c: free_name(f"{c} of order", df.columns) for c in order_by if c in digested}
        ordered = _digested(df.withColumns({k: col(c) for c, k in keys.items()}) if keys else df, digested)
        labels = LabelEncode.fit(ordered, names, [keys.get(c, c) for c in order_by], driver_levels)
        offsets, width = {}, 0
        for name in targets(names, [*labels.lists, *labels.tables]):
            offsets[name] = width
            width += len(labels.lists[name]) if name in labels.lists else labels.sizes[name][0]
        return SparseOneHot(labels, offsets, width, digested)

    def apply(self, df: DataFrame, name: str = "onehot") -> DataFrame:
        """The other columns of ``df``, then ``name``: the numbers, an ascending array of longs."""
        sources = [n for n in self.offsets if n in df.columns]
        others = [c for c in df.columns if c not in sources]
        coded = self.labels.apply(_digested(df, [n for n in self.digested if n in df.columns]))
        numbers = [col(n).cast("bigint") + (self.offsets[n] - 1) for n in sources]
        active = F.array_compact(F.array(*numbers)) if numbers else F.array().cast("array<bigint>")
        return coded.select(*[col(c) for c in others], active.alias(free_name(name, others)))

    def indicators(self, spark: SparkSession) -> DataFrame:
        """``position, column, level`` of every indicator; the level of a digested column is its digest."""
        parts = [
            spark.createDataFrame(
                [(self.offsets[n] + i, n, level) for i, level in enumerate(levels)], "position bigint, column string, level string"
            )
            for n, levels in self.labels.lists.items()
        ] + [
            table.select(
                (F.col("code") + F.lit(self.offsets[n] - 1).cast("bigint")).alias("position"), F.lit(n).alias("column"), F.col("key").alias("level")
            )
            for n, table in self.labels.tables.items()
        ]
        empty = spark.createDataFrame([], "position bigint, column string, level string")
        return reduce(DataFrame.unionAll, parts, empty)
