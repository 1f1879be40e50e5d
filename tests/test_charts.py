import pytest
from pyspark.sql import functions as F

from kempt.operators import explore


@pytest.fixture
def points(spark):
    return spark.createDataFrame(
        [(1.0, 2.0, "u"), (2.0, None, "u"), (3.0, 7.0, "v"), (None, 1.0, "v"), (4.0, 7.0, None)], "x double, y double, c string")


def test_pairwise_correlation(points):
    got = {(r["x"], r["y"]): r["r"] for r in explore.correlations(points).collect()}
    assert got == {("x", "x"): 1.0, ("y", "y"): 1.0, ("x", "y"): 0.94, ("y", "x"): 0.94}


def test_correlation_needs_two_varying_columns(spark, points):
    assert explore.correlations(points.select("x", F.lit(1.0).alias("k"), F.lit(None).cast("double").alias("n"))).count() == 0
    assert explore.correlations(points.select("c")).count() == 0
    # Both vary, but not on the rows they share.
    apart = spark.createDataFrame([(1.0, None), (2.0, 5.0), (2.0, 6.0)], "a double, b double")
    got = {(r["x"], r["y"]): r["r"] for r in explore.correlations(apart).collect()}
    assert got["a", "b"] is None and got["b", "a"] is None


def test_correlation_in_passes(spark, monkeypatch):
    df = spark.range(50).select(*[((F.col("id") * k) % 7).cast("double").alias(f"c{k}") for k in (1, 2, 3, 4)])
    whole = sorted(map(tuple, explore.correlations(df).collect()))
    monkeypatch.setattr(explore, "PAIRS_PER_PASS", 2)
    assert sorted(map(tuple, explore.correlations(df).collect())) == whole and len(whole) == 16


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10)] + [(None,), (float("nan"),)], "x double")
    got = {r["bin"]: (r["bin_start"], r["bin_end"], r["count"]) for r in explore.histogram(df, "x", 5).collect()}
    assert got == {1: (0.0, 2.0, 2), 2: (2.0, 4.0, 1), 5: (8.0, 10.0, 2)}
    same = explore.histogram(df.where("x = 2"), "x").collect()
    assert [tuple(r) for r in same] == [(1, 2.0, 2.0, 1)]
    assert explore.histogram(df.where("x is null"), "x").count() == 0


@pytest.mark.parametrize("group_rows", [1000, 3])
def test_boxes(spark, group_rows):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 4.0, 100.0)] + [(None, 5.0), ("b", None)], "g string, v double")
    got = {r["group"]: r for r in explore.box_summary(df, "v", "g", group_rows).collect()}
    assert set(got) == {"a", None}
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["outliers"], got["a"]["median"]) == (1.0, 4.0, 1, 3.0)
    assert [tuple(r) for r in explore.box_outliers(df, "v", "g", group_rows).collect()] == [("a", 100.0)]
    assert explore.box_summary(df, "v").first()["n"] == 6
    assert explore.box_summary(df.where("v is null"), "v").count() == 0


def test_violin_density_is_one(points):
    whole = explore.violin_summary(points, "x", bins=4).collect()
    assert sum(r["density"] * (r["bin_end"] - r["bin_start"]) for r in whole) == pytest.approx(1.0)
    assert {(r["group"], r["mean"], r["median"]) for r in whole} == {("all", 2.5, 2.5)}
    rows = explore.violin_summary(points, "x", "c", bins=4).collect()
    for g in ("u", "v", None):
        mine = [r for r in rows if r["group"] == g]
        assert sum(r["density"] * (r["bin_end"] - r["bin_start"]) for r in mine) == pytest.approx(1.0)


def test_scatter_and_trend(points):
    assert explore.scatter_points(points, "x", "y", "c").count() == 3
    assert explore.has_points(points, "x", "y") and not explore.has_points(points.where("c = 'u' and x > 1"), "x", "y")
    flat = explore.trend_line(points.withColumn("x", F.lit(1.0)), "x", "y").first()
    assert flat["slope"] is None and flat["intercept"] is None


def test_bars(points):
    assert [tuple(r) for r in explore.frequencies(points, "c").collect()] == [("u", 2), ("v", 2), (None, 1)]
    got = {r["x"]: (r["count"], r["sum"]) for r in explore.bar_totals(points, "c", "y").collect()}
    assert got == {"u": (1, 2.0), "v": (2, 8.0), None: (1, 7.0)}
