import math
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.operators import explore, profile
from kempt.operators.duplicates import (
    count_duplicates, flag_duplicates, handle_duplicates, hash_counts, repeated_rows, row_hash,
)
from kempt.operators.missing import FillMissing, handle_missing, strategies
from kempt.operators.standardize import Standardize


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def copies(spark):
    data = [(1, float("nan"), "a"), (1, float("nan"), "a"), (1, None, "a"), (2, 0.0, None), (2, -0.0, None)]
    return spark.createDataFrame(data * 3 + [(9, 9.0, "z")], "k int, x double, s string")


@pytest.mark.parametrize("copies_per_task", [1_000_000, 2])
def test_flag_marks_all_but_one(copies, copies_per_task):
    flagged = flag_duplicates(copies, copies_per_task)
    assert flagged.columns == ["k", "x", "s", "duplicate_flag"]
    assert flagged.count() == copies.count() == 16
    assert flagged.where("duplicate_flag").count() == count_duplicates(copies).first()[0] == 12
    assert flagged.where("not duplicate_flag").drop("duplicate_flag").distinct().count() == 4


def test_counting_compares_rows_that_share_a_hash(spark, copies):
    extra = lambda found: found[0].agg(F.sum(F.col(found[1]) - 1)).first()[0]
    constant = lambda df: F.lit(7).cast("bigint")
    few = lambda df: F.pmod(row_hash(df), F.lit(2))
    assert extra(repeated_rows(copies)) == extra(repeated_rows(copies, constant)) == extra(repeated_rows(copies, few)) == 12
    assert extra(repeated_rows(copies, hashes=0)) == 12
    # Different rows of one hash are no copies; nulls in other columns are told apart.
    different = spark.createDataFrame([(1, None, "a"), (None, 1, "a"), (1, 1, None)], "hash int, n int, copies string")
    assert extra(repeated_rows(different, constant)) == 0 and count_duplicates(different).first()[0] == 0
    assert different.select(row_hash(different)).distinct().count() == 3
    maps = spark.createDataFrame([({"a": 1, "b": 2}, "X"), ({"b": 2, "a": 1}, "x")], "m map<string,int>, t string")
    assert count_duplicates(maps).first()[0] == 0 and count_duplicates(maps.select("m")).first()[0] == 1
    assert count_duplicates(maps.select(F.expr("t collate UTF8_LCASE as t"))).first()[0] == 1
    assert count_duplicates(copies.limit(0)).first()[0] == 0


def test_counting_shuffles_hashes_only(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    plan = hash_counts(table, "hash")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchange = plan[plan.index(") Exchange\n"):]
    assert re.match(r"\) Exchange\nInput \[2\]: \[hash#\d+L, count#\d+L\]", exchange), exchange[:200]


def test_remove_is_idempotent(copies):
    once = handle_duplicates(copies, "remove")
    assert once.count() == 4 and count_duplicates(once).first()[0] == 0
    assert handle_duplicates(once, "remove").count() == 4


def test_flag_with_nested_columns(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, [1]), ({"b": 2, "a": 1}, [1])], "m map<string,int>, l array<int>")
    assert flag_duplicates(df).where("duplicate_flag").count() == 1


def test_unknown_action(copies):
    with pytest.raises(ValueError):
        handle_duplicates(copies, "squash")


def test_standardize(spark):
    df = spark.createDataFrame(
        [("\t Yes ", "x", " NaN", True), ("0", "1", None, None), ("none", " ", "n/a", False)],
        T.StructType([T.StructField(n, t) for n, t in zip(
            ["A b", "a-B", "c", "2"], [T.StringType()] * 3 + [T.BooleanType()])]),
    )
    out = Standardize.fit(df).apply(df)
    assert out.columns == ["a_b", "a_b_1", "c", "x_2"]
    assert [tuple(r) for r in out.collect()] == [
        ("Yes", "x", None, True), ("No", "1", None, None), (None, None, None, False)]


def test_standardize_columns_that_differ_in_case_only(spark):
    df = spark.createDataFrame([(" y", "n")], "p string, q string").toDF("Name", "name")
    assert Standardize.fit(df).apply(df).first().asDict() == {"name": "Yes", "name_1": "No"}


def test_modes_and_ties(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b")], "id bigint, v string")
    assert explore.mode_first(df, ["v"], ["id"]).first()["mode"] == "b"
    assert explore.mode_first(df, ["v"], ["v", "id"]).first()["mode"] == "a"
    assert explore.categorical_insight(df, "v").first()["mode"] == "a"


def test_strategies():
    assert strategies(T.DecimalType(10, 2)) == ("keep", "drop_rows", "median", "mean", "zero")
    assert strategies(T.DateType()) == ("keep", "drop_rows", "mode", "missing_label")


def test_unsuitable_strategy_is_refused(spark):
    df = spark.createDataFrame([(1, "a")], "x int, s string")
    for rules in ({"x": "mode"}, {"s": "median"}, {"s": "guess"}):
        with pytest.raises(ValueError):
            FillMissing.fit(df, rules)


def test_drops_come_in_table_order(spark):
    df = spark.createDataFrame(
        [(1.0, None), (None, 1), (3.0, 1), (5.0, None), (100.0, None)], "x double, y int")
    # y is dropped after x in table order, so the mean of x still sees every row.
    assert rows(handle_missing(df, {"y": "drop_rows", "x": "mean"})) == [(27.25, 1), (3.0, 1)]
    # Seen the other way round, only the rows with y are left for the mean.
    other = df.select("y", "x")
    assert rows(handle_missing(other, {"y": "drop_rows", "x": "mean"})) == [(1, 3.0), (1, 3.0)]


def test_all_missing(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a double, b int, s string, f boolean")
    out = handle_missing(df, {"a": "mean", "b": "median", "s": "mode", "f": "missing_label"})
    assert [tuple(r) for r in out.collect()] == [(0.0, None, "Missing", "Missing")]


def test_mode_keeps_the_type(spark):
    df = spark.sql("select date'2024-01-02' as d, true as f union all select null, null")
    out = handle_missing(df, {"d": "mode", "f": "mode"})
    assert [f.dataType for f in out.schema] == [T.DateType(), T.BooleanType()]
    assert out.where("d is null or f is null").count() == 0


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (4.0,), (None,)], "x double")
    assert rows(handle_missing(df, {"x": "zero"})) == [(0.0,), (0.0,), (4.0,)]
    assert profile.missing_profile(df).first().asDict() == {
        "column": "x", "dtype": "double", "missing": 2, "missing_pct": 66.67, "unique": 1}


def test_profiles_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "x double, s string")
    assert tuple(profile.quick_stats(empty).first()) == (0, 0, 0, 0, 0, 0)
    assert tuple(profile.stage_stats(empty).first()) == (0, 2, 1, 1, 0, 0)
    assert profile.overview(empty).first()[0] == "No rows available."
    assert profile.missing_columns(empty).count() == 0
    top = {r["column"]: (r["mean"], r["top"]) for r in profile.summary_table(empty).collect()}
    assert top == {"x": (None, None), "s": (None, "Missing")}


def test_summary_without_text_or_numbers(spark):
    numbers = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert [r["top"] for r in profile.summary_table(numbers).collect()] == [None, None]
    words = spark.createDataFrame([("p",), ("q",), ("q",)], "w string")
    assert [(r["unique"], r["top"], r["sd"]) for r in profile.summary_table(words).collect()] == [(2, "q", None)]


def test_distinct_counts(spark):
    df = spark.createDataFrame(
        [(1, 0.0, "a", True), (1, -0.0, "b", None), (None, float("nan"), "b", True)], "i int, d double, s string, f boolean")
    assert [tuple(r) for r in profile.distinct_counts(df).collect()] == [("i", 1), ("d", 1), ("s", 2), ("f", 1)]
    assert [r["unique"] for r in profile.distinct_counts(df, exact=False).collect()] == [1, 1, 2, 1]


def test_compare_verdicts(spark):
    before = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "x int, s string")
    after = before.where("s is not null").withColumn("y", F.lit(1))
    got = {r["metric"]: (r["delta"], r["verdict"]) for r in profile.compare_stages(before, after).collect()}
    assert got == {"rows": (-2, "worse"), "cols": (1, "improved"), "numeric": (1, "improved"),
                   "non_numeric": (0, "neutral"), "missing": (-2, "improved")}


def test_labels_drop_trailing_zeros(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (3, 1), (4, 1), (None, 2), (1, 2), (1, 2), (1, 2)], "a int, b int")
    assert [r["label"] for r in profile.missing_labels(df).collect()] == [
        "a (2 missing, 25% missing)", "b (1 missing, 12.5% missing)"]


def test_insight_falls_back_for_missing_numbers(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert tuple(explore.insight(df, "x").first()) == (0, 0, 2, "N/A", 0)


def test_insight_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "x double")
    r = explore.numeric_insight(df, "x").first()
    assert (r["sd"], r["skewness"], r["q1"], r["missing"]) == (0.0, 0.0, 2.0, 0)
    one = explore.numeric_insight(df.limit(1), "x").first()
    assert one["sd"] is None and one["skewness"] == 0.0 and not math.isnan(one["mean"])
