"""A whole preparation plan: described once, fitted on data, applied as a projection.

raw -> cleaned -> preprocessed -> featured -> filtered
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import clean_names
from ..operators.derive import FeatureRule, add_rule, apply_rules, remove_rule
from ..operators.duplicates import handle_duplicates
from ..operators.encode import LabelEncode, OneHotEncode
from ..operators.filters import RowFilter
from ..operators.missing import FillMissing
from ..operators.numeric import Outliers, Scaling
from ..operators.staging import collecting, release, staged
from ..operators.standardize import Standardize


@dataclass(frozen=True)
class Plan:
    """What to do. Column names are those of the standardized table, if it is standardized.

    ``order_by`` is a unique key that stands for the row order: it decides which value
    appeared first. Without it the smallest value counts as the first.
    """

    standardize: bool = False
    duplicates: str = "keep"
    drop_columns: Sequence[str] = ()
    missing: Mapping[str, str] = field(default_factory=dict)
    outlier: tuple[str, Sequence[str]] = ("none", ())
    scaling: tuple[str, Sequence[str]] = ("none", ())
    encoding: tuple[str, Sequence[str]] = ("none", ())
    features: Sequence[FeatureRule] = ()
    filter: RowFilter = RowFilter()
    order_by: Sequence[str] = ()
    exact: bool = True
    max_levels: int | None = None

    def add_feature(self, schema, operation, col1, col2=None, name=None) -> Plan:
        """``schema`` is that of the preprocessed table."""
        return replace(self, features=add_rule(self.features, schema, operation, col1, col2, name))

    def remove_feature(self, index: int) -> Plan:
        return replace(self, features=remove_rule(self.features, index))

    def reset_features(self) -> Plan:
        return replace(self, features=())

    def fit(self, df: DataFrame) -> FittedPlan:
        return self._fit(df)[0]

    def fit_transform(self, df: DataFrame) -> Stages:
        """Fit and apply to the same table; its duplicates are handled only once."""
        fitted, deduplicated = self._fit(df)
        return replace(fitted._after_duplicates(deduplicated), owner=fitted)

    def _fit(self, df: DataFrame) -> tuple[FittedPlan, DataFrame]:
        self._check(df)
        with collecting() as paths:
            fitted, start = self._fit_steps(df)
        return replace(fitted, spark=df.sparkSession, paths=tuple(paths)), start

    def _fit_steps(self, df: DataFrame) -> tuple[FittedPlan, DataFrame]:
        standardize = Standardize.fit(df) if self.standardize else None
        table = standardize.apply(df) if standardize else df
        table = handle_duplicates(table, self.duplicates)
        if self.duplicates != "keep":
            # The passes below read columns of the result; the shuffle runs once.
            table = staged(table, "deduplicated")
        start = table
        table = table.drop(*self.drop_columns)
        fill = FillMissing.fit(table, self.missing, self.order_by, self.exact)
        table = fill.apply(table)
        outliers = Outliers.fit(table, *self.outlier, exact=self.exact)
        table = outliers.apply(table)
        scaling = Scaling.fit(table, *self.scaling, exact=self.exact)
        table = scaling.apply(table)
        method, columns = self.encoding
        if method == "label":
            encoding = LabelEncode.fit(table, columns, self.order_by)
        elif method == "onehot":
            encoding = OneHotEncode.fit(table, columns, self.order_by, self.max_levels)
        elif method == "none":
            encoding = None
        else:
            raise ValueError(f"unknown encoding method: {method!r}")
        return FittedPlan(self, standardize, fill, outliers, scaling, encoding), start

    def _check(self, df: DataFrame) -> None:
        names = clean_names(df.columns) if self.standardize else df.columns
        absent = [c for c in self.order_by if c not in names]
        if absent:
            raise ValueError(f"order_by names no column of the table: {', '.join(absent)}")
        changed = set(self.drop_columns) | set(self.outlier[1]) | set(self.scaling[1])
        if changed & set(self.order_by):
            raise ValueError("order_by must not be dropped, capped or scaled")


@dataclass(frozen=True)
class Stages:
    """The table after each stage, all lazy. The export is ``featured``, not ``filtered``."""

    cleaned: DataFrame
    preprocessed: DataFrame
    featured: DataFrame
    filtered: DataFrame
    owner: FittedPlan | None = None

    def close(self) -> None:
        """Delete the intermediate tables of ``fit_transform``; the stages cannot be read afterwards."""
        if self.owner is not None:
            self.owner.close()


@dataclass(frozen=True)
class FittedPlan:
    plan: Plan
    standardize: Standardize | None
    fill: FillMissing
    outliers: Outliers
    scaling: Scaling
    encoding: LabelEncode | OneHotEncode | None
    spark: SparkSession | None = None
    paths: tuple[str, ...] = ()

    def close(self) -> None:
        """Delete the intermediate tables that fitting made. A plan with a long label dictionary needs its table."""
        if self.spark is not None:
            release(self.spark, self.paths)

    def stages(self, df: DataFrame) -> Stages:
        table = self.standardize.apply(df) if self.standardize else df
        return self._after_duplicates(handle_duplicates(table, self.plan.duplicates))

    def _after_duplicates(self, table: DataFrame) -> Stages:
        cleaned = self.fill.apply(table.drop(*self.plan.drop_columns))
        preprocessed = self.scaling.apply(self.outliers.apply(cleaned))
        if self.encoding is not None:
            preprocessed = self.encoding.apply(preprocessed)
        featured = apply_rules(preprocessed, self.plan.features)
        return Stages(cleaned, preprocessed, featured, self.plan.filter.apply(featured))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.stages(df).filtered
