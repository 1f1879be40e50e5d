import contextlib

import pytest
from pyspark.sql import functions as F

from kempt import FeatureRule, Plan, RowFilter
from kempt.operators import staging
from kempt.operators.derive import add_rule, apply_rules, remove_rule
from kempt.operators import encode
from kempt.operators.encode import LabelEncode, OneHotEncode, SparseOneHot, TooManyLevels
from kempt.operators.filters import level_domain, numeric_domain
from kempt.operators.numeric import Outliers, Scaling
from kempt.operators.running import running_total
from kempt.streaming.apply import transform_stream


def column(df, name):
    return [r[name] for r in df.collect()]


def test_outliers_need_four_values_and_a_spread(spark):
    few = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (900.0, 1.0), (None, 1.0), (None, 50.0)], "x double, y double")
    fitted = Outliers.fit(few, "cap", ["x", "y"])
    assert fitted.fences == {}
    assert column(fitted.apply(few), "x") == [1.0, 2.0, 900.0, None, None]


def test_cap_and_remove(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 100, None]], "x int")
    assert sorted(column(Outliers.fit(df, "cap", ["x"]).apply(df), "x"), key=str) == [1.0, 2.0, 3.0, 4.0, 7.0, None]
    assert sorted(column(Outliers.fit(df, "remove", ["x"]).apply(df), "x"), key=str) == [1, 2, 3, 4, None]
    assert Outliers.fit(df, "none", ["x"]).apply(df) is df
    with pytest.raises(ValueError):
        Outliers.fit(df, "trim", ["x"])


@pytest.mark.parametrize("method, want", [
    ("standard", [-1.0, 0.0, 1.0, None]), ("minmax", [0.0, 0.5, 1.0, None]), ("robust", [-1.0, 0.0, 1.0, None])])
def test_scaling(spark, method, want):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None), (3, 5.0, None), (None, None, None)], "x int, c double, n double")
    out = Scaling.fit(df, method, ["n", "c", "x", "absent"]).apply(df)
    assert column(out, "x") == want
    assert column(out, "c") == [0.0, 0.0, 0.0, None] and column(out, "n") == [None] * 4


def test_scaling_one_row_and_none(spark):
    df = spark.createDataFrame([(7.0,)], "x double")
    for method in ("standard", "minmax", "robust"):
        assert column(Scaling.fit(df, method, ["x"]).apply(df), "x") == [0.0]
    assert column(Scaling.fit(df.limit(0), "standard", ["x"]).apply(df.limit(0)), "x") == []


@pytest.fixture
def levels(spark):
    data = [(i, v) for i, v in enumerate(["b", "a", None, "b", "c d", "C-D", "a"])]
    return spark.createDataFrame(data, "id int, v string").repartition(3)


@pytest.mark.parametrize("driver_levels, rows_per_task", [(10_000, 100), (1, 100), (1, 2)])
def test_label_codes(levels, driver_levels, rows_per_task):
    fitted = LabelEncode.fit(levels, ["v"], ["id"], driver_levels, rows_per_task)
    assert bool(fitted.tables) == (driver_levels == 1)
    out = fitted.apply(levels).orderBy("id")
    assert out.columns == ["id", "v"] and column(out, "v") == [1, 2, 3, 1, 4, 5, 2]


def test_label_codes_by_value_and_unseen(spark, levels):
    fitted = LabelEncode.fit(levels, ["v"])
    assert fitted.lists["v"] == ("C-D", "Missing", "a", "b", "c d")
    fresh = spark.createDataFrame([(1, "zzz"), (2, "a")], "id int, v string")
    assert column(fitted.apply(fresh).orderBy("id"), "v") == [None, 3]


def test_many_labels_are_joined(spark):
    df = spark.range(100).select("id", F.concat(F.lit("v"), F.col("id") % 40).alias("v"))
    fitted = LabelEncode.fit(df, ["v"], ["id"])
    assert column(fitted.apply(df).orderBy("id"), "v") == [i % 40 + 1 for i in range(100)]


def test_long_levels_are_ranked_by_tasks_of_bounded_bytes(spark, monkeypatch):
    """Tied keys leave the order to the texts, so they are needed whole."""
    df = spark.range(60).selectExpr("id", "id div 4 as key", "repeat(chr(cast(122 - id % 4 as int)), 1000) || id as v")
    used = []
    monkeypatch.setattr(encode, "TASK_BYTES", 8_000)
    monkeypatch.setattr(
        encode, "running_total",
        lambda *args, rows_per_task, **more: used.append(rows_per_task) or running_total(*args, rows_per_task=rows_per_task, **more),
    )
    fitted = LabelEncode.fit(df, ["v"], ["key"])
    assert used == [7]      # 1,002 bytes each
    assert column(fitted.apply(df).orderBy("id"), "v") == [i // 4 * 4 + 4 - i % 4 for i in range(60)]


def test_onehot(levels):
    out = OneHotEncode.fit(levels, ["v"], ["id"]).apply(levels).orderBy("id")
    assert out.columns == ["id", "v_b", "v_a", "v_missing", "v_c_d", "v_c_d_1"]
    assert all(sum(list(r)[1:]) == 1 for r in out.collect())
    assert column(out, "v_c_d_1") == [0, 0, 0, 0, 0, 1, 0]


def test_onehot_refuses_wide_tables(spark, levels):
    with pytest.raises(TooManyLevels):
        OneHotEncode.fit(levels, ["v"], ["id"], max_levels=4)
    many = spark.range(1100).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(TooManyLevels):
        OneHotEncode.fit(many, ["v"], max_levels=1000)
    assert len(OneHotEncode.fit(many, ["v"], max_levels=1100).levels["v"]) == 1100


@pytest.mark.parametrize("quick, driver_levels", [(1000, 10_000), (3, 10_000), (3, 1)])
def test_sparse_onehot_lists_what_the_dense_form_marks(spark, levels, monkeypatch, quick, driver_levels):
    """Fetched at once, through the stored levels, and ranked in the cluster: the same numbers."""
    monkeypatch.setattr(encode, "QUICK_LEVELS", quick)
    df = levels.withColumn("w", F.when(F.col("id") % 3 > 0, F.concat(F.lit("w"), F.col("id") % 2))).withColumn("onehot", F.lit(1))
    dense = OneHotEncode.fit(df, ["w", "v"], ["id"]).apply(df).orderBy("id").collect()
    fitted = SparseOneHot.fit(df, ["w", "v"], ["id"], driver_levels)
    assert bool(fitted.labels.tables) == (driver_levels == 1)
    out = fitted.apply(df).orderBy("id")
    assert out.columns[:2] == ["id", "onehot"] and len(out.columns) == 3 and fitted.width == len(dense[0]) - 2
    for d, row in zip(dense, out.collect()):
        assert row[2] == [i for i, v in enumerate(d[2:]) if v == 1] and len(row[2]) == 2
    index = fitted.indicators(spark).orderBy("position").collect()
    assert [r["position"] for r in index] == list(range(fitted.width))
    assert [r["level"] for r in index if r["column"] == "v"] == ["b", "a", "Missing", "c d", "C-D"]
    fresh = fitted.apply(spark.createDataFrame([("new", "a"), (None, None)], "w string, v string")).collect()
    place = {(r["column"], r["level"]): r["position"] for r in index}
    assert [r[0] for r in fresh] == [[place["v", "a"]], [place["w", "Missing"], place["v", "Missing"]]]


def test_sparse_onehot_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, v string")
    fitted = SparseOneHot.fit(empty, ["v"])
    assert fitted.width == 0 and fitted.apply(empty).count() == 0 and fitted.indicators(spark).count() == 0


def test_dense_onehot_refuses_names_by_their_bytes(spark, monkeypatch):
    df = spark.range(40).select(F.concat(F.lit("x" * 600), F.col("id")).alias("v"))
    assert len(OneHotEncode.fit(df, ["v"]).levels["v"]) == 40
    monkeypatch.setattr(encode, "NAME_BYTES", 20_000)
    with pytest.raises(TooManyLevels, match="SparseOneHot"):
        OneHotEncode.fit(df, ["v"])
    assert SparseOneHot.fit(df, ["v"]).width == 40


def test_sparse_onehot_digests_long_texts(spark):
    rows = [(i, ("x" * 600 + str(i % 50)) if i % 60 else None, f"s{i % 3}") for i in range(180)]
    df = spark.createDataFrame(rows, "id int, v string, w string").repartition(5)
    fitted = SparseOneHot.fit(df, ["w", "v"], ["id"], driver_levels=1)
    assert fitted.digested == ("v",) and fitted.width == 54 and "v" in fitted.labels.tables
    place = {v: i for i, v in enumerate(dict.fromkeys(v for _, v, _ in rows))}
    out = fitted.apply(df).orderBy("id")
    assert [r["onehot"] for r in out.collect()] == [[i % 3, 3 + place[v]] for i, v, _ in rows]
    assert max(len(r["level"]) for r in fitted.indicators(spark).collect()) == 64
    by_text = SparseOneHot.fit(df, ["v"], ["v"])
    assert by_text.apply(df).select("onehot").distinct().count() == 51


def test_few_levels_are_not_written_and_applying_starts_no_job(spark, monkeypatch):
    df = spark.range(300).select("id", F.concat(F.lit("k"), F.col("id") % 60).alias("v"), F.lit("a").alias("w"))
    monkeypatch.setattr(encode, "staged", lambda *a: pytest.fail("written"))
    fitted = LabelEncode.fit(df, ["v", "w"], ["id"])
    assert fitted.sizes["v"][0] == 60 and OneHotEncode.fit(df, ["w"]).levels == {"w": ("a",)}
    monkeypatch.setattr(type(df), "first", lambda *a: pytest.fail("a job"))
    monkeypatch.setattr(type(df), "count", lambda *a: pytest.fail("a job"))
    assert [r["v"] for r in fitted.apply(df).orderBy("id").collect()] == [i % 60 + 1 for i in range(300)]


def test_encoding_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int, v string")
    assert LabelEncode.fit(empty, ["v"]).apply(empty).columns == ["id", "v"]
    assert OneHotEncode.fit(empty, ["v"]).apply(empty).columns == ["id", "v"]


def test_arithmetic(spark):
    df = spark.createDataFrame([(6.0, 0.0, "x"), (-2.0, 4.0, " 3 "), (None, 1.0, None)], "a double, b double, t string")
    rules = [FeatureRule(op, op, "a", "b") for op in ("add", "subtract", "multiply", "divide", "log", "square", "sqrt", "abs")]
    out = apply_rules(df, [*rules, FeatureRule("text", "add", "t", "b"), FeatureRule("none", "add", "a", "absent")])
    assert "none" not in out.columns
    first, second, third = out.collect()
    assert first["divide"] is None and second["divide"] == -0.5
    assert second["log"] is None and second["sqrt"] is None and second["abs"] == 2.0 and second["square"] == 4.0
    assert (first["text"], second["text"], third["text"], third["add"]) == (None, 7.0, None, None)


def test_rules_chain_and_overwrite(spark):
    df = spark.createDataFrame([(2.0,)], "a double")
    rules = [FeatureRule("b", "square", "a"), FeatureRule("a", "add", "a", "b"), FeatureRule("c", "add", "a", "b")]
    assert tuple(apply_rules(df, rules).first()) == (6.0, 4.0, 10.0)


def test_add_and_remove_rules(spark):
    schema = spark.createDataFrame([], "a double, b int, s string").schema
    rules = add_rule((), schema, "add", "a", "b")
    rules = add_rule(rules, schema, "add", "a", "b")
    rules = add_rule(rules, schema, "log", "a_add_b", "b", name="  My Log! ")
    assert [(r.name, r.col2) for r in rules] == [("a_add_b", "b"), ("a_add_b_2", "b"), ("my_log", None)]
    assert [r.name for r in remove_rule(rules, 1)] == ["a_add_b", "my_log"]
    assert remove_rule(rules, 9) == rules
    for bad in (("add", "s", "a"), ("add", "a", "s"), ("cube", "a", None), ("add", "a", None)):
        with pytest.raises(ValueError):
            add_rule(rules, schema, *bad)


def test_filters(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (float("nan"), "b"), (None, "a")], "x double, s string")
    assert column(RowFilter("x", range=(1, 2)).apply(df), "x") == [1.0, 2.0]
    assert RowFilter("x", range=(0, float("inf"))).apply(df).count() == 2
    assert column(RowFilter("s", levels=["a"]).apply(df), "s") == ["a", "a"]
    long = RowFilter("s", levels=[*map(str, range(20_000)), "b"])
    assert column(long.apply(df), "s") == ["b"]
    assert tuple(numeric_domain(df.withColumn("x", F.col("x") + 0.005), "x").first()) == (1.0, 2.01, 1.005, 2.005)
    assert numeric_domain(df.where("x is null"), "x").count() == 0
    assert column(level_domain(df, "s"), "level") == ["a", "b"]
    flags = df.select((F.col("s") == "a").alias("f"))
    assert column(level_domain(flags, "f"), "level") == ["FALSE", "TRUE"]
    assert column(RowFilter("f", levels=["TRUE"]).apply(flags), "f") == [True, True]


def test_plan_edits_and_checks(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0)], "id int, x double")
    plan = Plan(order_by=("id",)).add_feature(df.schema, "square", "x").add_feature(df.schema, "abs", "x")
    assert [f.name for f in plan.remove_feature(0).features] == ["abs_x"]
    assert plan.reset_features().features == ()
    assert column(plan.fit(df).transform(df), "square_x") == [4.0, 16.0]
    for bad in (Plan(order_by=("nope",)), Plan(order_by=("x",), scaling=("standard", ["x"])),
                Plan(encoding=("hash", ["x"])), Plan(duplicates="some")):
        with pytest.raises(ValueError):
            bad.fit(df)


plan_closed = contextlib.closing


def test_export_is_not_filtered(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    stages = Plan(filter=RowFilter("x", range=(2, 3))).fit_transform(df)
    assert stages.featured.count() == 3 and stages.filtered.count() == 2


def test_fitted_plan_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, None), (3, "b", 6.0)], "id int, s string, x double")
    df.write.parquet(f"{tmp_path}/in")
    plan = Plan(missing={"x": "mean"}, scaling=("minmax", ["x"]), encoding=("label", ["s"]), order_by=("id",))
    fitted = plan.fit(df)
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    run = (
        transform_stream(fitted, stream).writeStream.format("parquet")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    )
    run.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted(tuple(r) for r in fitted.transform(df).collect())
    with pytest.raises(ValueError):
        transform_stream(fitted, df)
    with pytest.raises(ValueError):
        transform_stream(Plan(duplicates="remove").fit(df), stream)


def test_dotted_names_all_the_way(spark):
    data = [(i, float(i % 7), [None, "x", "y z"][i % 3], 1.0) for i in range(30)]
    df = spark.createDataFrame(data, "id int, v double, s string, w double").toDF("id", "Sepal.Length", "Kind of `x`", "w")
    plan = Plan(
        duplicates="flag", drop_columns=("w",), missing={"Kind of `x`": "mode"}, outlier=("cap", ["Sepal.Length"]),
        scaling=("standard", ["Sepal.Length"]), encoding=("label", ["Kind of `x`"]),
        features=(FeatureRule("a.b", "square", "Sepal.Length"), FeatureRule("c", "add", "a.b", "id")),
        filter=RowFilter("a.b", range=(0, 100)), order_by=("id",),
    )
    out = plan.fit_transform(df).filtered
    assert out.columns == ["id", "Sepal.Length", "Kind of `x`", "duplicate_flag", "a.b", "c"] and out.count() == 30
    assert {r[2] for r in out.collect()} == {1, 2}


def test_long_labels_stay_off_the_driver(spark):
    df = spark.createDataFrame([(1, "b" * 2000), (2, "a"), (3, "b" * 2000)], "id int, v string")
    fitted = LabelEncode.fit(df, ["v"], ["id"])
    assert not fitted.lists and column(fitted.apply(df).orderBy("id"), "v") == [1, 2, 1]


def test_every_numeric_type(spark):
    df = spark.sql("""select cast(id as byte) b, cast(id as short) s, cast(id as decimal(10, 2)) d, cast(id as float) f, id
                      from range(9)""").union(spark.sql("select null, null, null, null, null"))
    names = ["b", "s", "d", "f", "id"]
    plan = Plan(missing=dict(zip(names, ["median", "mean", "median", "mean", "zero"])),
                outlier=("cap", names), scaling=("minmax", names))
    out = plan.fit_transform(df).preprocessed.collect()
    assert len(out) == 10 and all(0.0 <= v <= 1.0 for r in out for v in r)


def test_intermediate_tables_are_released(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda spark: str(tmp_path / "shared"))
    df = spark.createDataFrame([(i, f"w{i % 40}", float(i)) for i in range(200)], "id int, s string, x double")
    plan = Plan(duplicates="remove", scaling=("robust", ["x"]), encoding=("label", ["s"]), order_by=("id",))
    stages = plan.fit_transform(df)
    assert stages.filtered.count() == 200 and list((tmp_path / "shared").iterdir())
    stages.close()
    assert not list((tmp_path / "shared").iterdir())
    with plan_closed(plan.fit(df)) as fitted:
        assert fitted.transform(df).count() == 200
    assert not list((tmp_path / "shared").iterdir())
