"""What counts as equal, which order levels have, and that no name of a user's column is reserved."""

import pytest
from pyspark.sql import functions as F

from kempt import FeatureRule, Plan, RowFilter
from kempt.functions.columns import number
from kempt.operators import duplicates, explore, filters, lookup, profile
from kempt.operators.counts import modes, text_counts
from kempt.operators.derive import apply_rules
from kempt.operators.encode import LabelEncode, OneHotEncode, TooManyLevels
from kempt.operators.running import running_total

INTERNAL = [
    "_copies", "_copy", "_from", "copies", "copy", "start", "_level", "level", "_key", "_k", "_hot", "_salt", "_rest", "_s",
    "_code", "code", "key", "n", "value", "number", "first", "before", "_w", "_part", "_rows", "g", "v", "cell", "there", "lane0", "full",
]


def test_times_that_read_alike_are_different(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # Two of these are the same hour on the clock, before and after it was set back.
        df = spark.sql("select timestamp_seconds(s) t from values (1698537600), (1698541200), (1698544800) as x(s)")
        assert profile.distinct_counts(df).first()["unique"] == 3
        row = modes(text_counts(df.unionAll(df.limit(0)), ["t"])).first()
        assert row["unique"] == 3 and row["top_count"] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nested_values_that_read_alike(spark):
    df = spark.sql("""select * from values
      (array('a, b'), named_struct('x', 'p, q', 'y', 'r'), map('k', '1', 'l', '2')),
      (array('a', 'b'), named_struct('x', 'p', 'y', 'q, r'), map('l', '2', 'k', '1')),
      (array(cast(null as string)), named_struct('x', 'p', 'y', 'q, r'), map('k', '1, l -> 2')),
      (array('null'), null, null) as t(a, s, m)""")
    assert {r["column"]: r["unique"] for r in profile.distinct_counts(df).collect()} == {"a": 4, "s": 2, "m": 2}
    found = {r["number"]: (r["unique"], r["top_count"]) for r in modes(text_counts(df.select("a", "s"), ["a", "s"])).collect()}
    assert found == {0: (4, 1), 1: (2, 2)}


def test_distinct_numbers_at_the_ends_of_their_types(spark):
    """Bitmaps over negative numbers and the ends of each type; -0.0 is 0.0; neighbouring doubles stay apart."""
    longs = [-(2**63), -(2**63) + 1, -65, -64, -63, -1, 0, 1, 63, 64, 2**63 - 1, None, 0, 63, -64]
    doubles = [0.0, -0.0, 5e-324, 1e308, float("inf"), float("-inf"), 1.0, 1.0000000000000002, float("nan"), None, 0.1, 0.3, -0.3, 0.1 + 0.2, 1.0]
    df = spark.createDataFrame(list(zip(longs, doubles)), "l long, d double").repartition(4)
    df = df.selectExpr("l", "d", "cast(d as float) f", "l > 0 as b", "date_add(date'1970-01-01', cast(l % 1000 as int)) as t",
                       "timestamp_micros(l % 1000) as s", "cast(l % 100 as byte) y", "cast(l % 100 as decimal(10, 2)) c")
    want = {}
    plain = [tuple(r) for r in df.collect()]
    for i, c in enumerate(df.columns):
        want[c] = len({r[i] for r in plain if r[i] is not None and r[i] == r[i]})
    assert {r["column"]: r["unique"] for r in profile.distinct_counts(df).collect()} == want
    assert want["l"] == 11 and want["d"] == 11


def test_distinct_numbers_of_a_wide_range(spark):
    df = spark.range(200_000).selectExpr("id", "(id * 2654435761) % 1000003 as m", "sqrt(id % 50000) as r", "id / 64 as q", "-id as g")
    want = {c: df.select(c).distinct().count() for c in df.columns}
    assert {r["column"]: r["unique"] for r in profile.distinct_counts(df).collect()} == want


def test_label_order_is_the_same_on_both_sides_of_the_limit(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 3.0), ("b", None), ("c", nan), ("d", 1.0), ("e", None), ("b", None), ("d", nan)], "v string, k double")
    expected = {"b": 1, "e": 2, "d": 3, "a": 4, "c": 5}
    for limit in (10_000, 0):
        coded = LabelEncode.fit(df, ["v"], ["k"], driver_levels=limit).apply(df.withColumn("raw", F.col("v")))
        assert {r["raw"]: r["v"] for r in coded.collect()} == expected
    assert OneHotEncode.fit(df, ["v"], ["k"]).levels["v"] == ("b", "e", "d", "a", "c")
    with pytest.raises(TooManyLevels):
        OneHotEncode.fit(df, ["v"], ["k"], max_levels=4)


def test_a_column_with_every_internal_name(spark):
    names = [*INTERNAL, "id", "word"]
    rows = [(*[float((i + k) % 5) for k in range(len(INTERNAL))], i % 20, f"w{i % 30}") for i in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {'int' if n == 'id' else 'string' if n == 'word' else 'double'}" for n in names))
    plan = Plan(
        duplicates="flag", missing={"_copies": "median"}, outlier=("cap", ["_from"]), scaling=("standard", ["_key"]),
        encoding=("label", ["word"]), features=(FeatureRule("_batch", "add", "_s", "_w"),), filter=RowFilter("_hot", range=(0, 3)),
        order_by=("id",),
    )
    out = plan.fit_transform(df).filtered
    assert set(names) < set(out.columns) and out.count() == df.where("_hot between 0 and 3").count()
    assert profile.quick_stats(df).first()["rows"] == 60 and duplicates.count_duplicates(df).first()[0] == 0
    assert profile.summary_table(df, ["id"]).count() == len(names) == profile.missing_profile(df).count()
    assert filters.RowFilter("word", levels=["w1", "w2"]).apply(df, list_levels=1).count() == 4
    dictionary = spark.createDataFrame([(f"w{i}", 2, i) for i in range(30)], "key string, n bigint, number_of_word int")
    for size in (1 << 20, 0):
        got = lookup.attach(df, F.col("word"), dictionary, size)
        assert got.columns == [*names, "number_of_word"] and got.where("word <> concat('w', number_of_word)").count() == 0
    assert running_total(df.select("id", "_w").distinct(), [], ["id", "_w"]).count() == df.select("id", "_w").distinct().count()


def test_rule_names_without_case(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, B double")
    rules = (FeatureRule("Net", "add", "A", "b"), FeatureRule("net", "multiply", "NET", "b"), FeatureRule("c", "subtract", "nEt", "a"))
    out = apply_rules(df, rules)
    assert out.columns == ["a", "B", "Net", "c"] and tuple(out.first()) == (2.0, 3.0, 15.0, 13.0)


@pytest.mark.parametrize("text, value", [
    ("5f", None), ("7d", None), ("1e3", 1000.0), (" -2.5 ", -2.5), (".5", 0.5), ("5.", 5.0), ("x", None), ("", None), ("NaN", None), ("1_0", None),
])
def test_text_that_is_a_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(number(df.schema["s"])).first()[0] == value


def test_charts_refuse_text(spark):
    df = spark.createDataFrame([("1", 2.0)], "s string, x double")
    for draw in (lambda: explore.box_summary(df, "s"), lambda: explore.scatter_points(df, "x", "s")):
        with pytest.raises(ValueError, match="not a numeric column"):
            draw()


def test_level_selection(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    pick = lambda current: [tuple(r) for r in filters.level_domain(df, "s", current).collect()]
    assert pick(["b", "z"]) == [("a", False), ("b", True)]
    assert pick(["z"]) == pick([]) == [("a", True), ("b", True)]
    assert [tuple(r) for r in filters.level_domain(df, "s").collect()] == [("a",), ("b",)]
