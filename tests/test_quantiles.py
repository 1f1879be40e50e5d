import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kempt.operators import quantiles as Q
from kempt.operators.running import running_total

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_small_column(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    assert Q.quantiles(df, {"x": F.col("x")}, [0.25, 0.5, 0.75]) == {"x": [1.75, 3.0, 5.5]}


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    found = Q.quantiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.5])
    assert found == {"x": [None], "y": [1.0]}


def columns():
    rng = random.Random(7)
    hot = [5.0] * 700 + [rng.gauss(0, 1) for _ in range(1400)]       # a third of all rows
    heavy = [math.exp(rng.gauss(0, 9)) for _ in range(2100)]         # many magnitudes
    few = [float(rng.choice([1, 2, 3])) for _ in range(2100)]
    same = [2.5] * 2100
    steps = [float(i // 700) for i in range(2100)]
    return [list(v) for v in zip(hot, heavy, few, same, steps)]


@pytest.mark.parametrize("sort_rows", [100_000, 300, 10, 1])
def test_search_matches_numpy(spark, sort_rows, monkeypatch):
    monkeypatch.setattr(Q, "ACCURACY", 50)
    rows = columns()
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5).cache()
    found = Q.quantiles(df, {c: F.col(c) for c in df.columns}, PROBS, sort_rows=sort_rows)
    for i, name in enumerate(df.columns):
        want = np.quantile([r[i] for r in rows], PROBS)
        assert found[name] == pytest.approx(list(want), rel=1e-12)


def test_poor_guesses_only_cost_rounds(spark, monkeypatch):
    def ends(table, column, places):
        (_, low, high), = places
        return {"x": [0.0 if low is None else low + 1, 499.0 if high is None else high - 1]}

    monkeypatch.setattr(Q, "_guess", ends)
    df = spark.range(500).select(F.col("id").cast("double").alias("x"))
    found = Q.quantiles(df, {"x": F.col("x")}, [0.5], sort_rows=490)
    assert found == {"x": [249.5]}


def test_few_passes_over_many_rows(spark, monkeypatch):
    """One guess, one count and one sort at 3 million rows."""
    calls = []
    for name in ("_guess", "_count_at", "_sort"):
        monkeypatch.setattr(Q, name, lambda *a, run=getattr(Q, name), name=name: calls.append(name) or run(*a))
    df = spark.range(3_000_000).select(((F.col("id") * 7919) % 3_000_000).cast("double").alias("x"))
    found = Q.quantiles(df, {"x": F.col("x")}, [0.25, 0.5], counts={"x": 3_000_000})
    assert found == {"x": [749_999.75, 1_499_999.5]} and calls == ["_guess", "_count_at", "_sort"]


def test_approximate(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert Q.quantiles(df, {"x": F.col("x")}, [0.5], exact=False) == {"x": [500.0]}


@pytest.mark.parametrize("group_rows", [10_000, 5])
def test_grouped(spark, group_rows):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else None, round(rng.gauss(0, 5), 1)) for i in range(900)] + [("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = Q.grouped_quantiles(df, "g", "v", [0.25, 0.5, 0.9], group_rows, rows_per_task=40).collect()
    assert {r["g"] for r in found} == {"hot", None, "one"}
    for r in found:
        values = [v for g, v in rows if g == r["g"]]
        assert r["n"] == len(values)
        assert [r["q0"], r["q1"], r["q2"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])), abs=1e-9)


@pytest.mark.parametrize("rows_per_task", [1000, 7])
def test_running_total(spark, rows_per_task):
    df = spark.range(200).select(F.when(F.col("id") % 3 > 0, "x").alias("g"), "id", (F.col("id") % 5).alias("w"))
    got = running_total(df, ["g"], ["id"], F.col("w"), rows_per_task=rows_per_task).collect()
    assert len(got) == 200
    for r in got:
        same = lambda i: (i % 3 > 0) == (r["g"] == "x")
        assert r["before"] == sum(i % 5 for i in range(r["id"]) if same(i))
