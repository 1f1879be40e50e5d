"""What the physical plans must, and must not, contain."""

import pytest

import __spark_entry__ as entry
from kempt import Plan, RowFilter
from kempt.operators import duplicates, profile
from queries.inputs import table

QUERIES = {name: function for name, function in entry.queries().items() if name not in entry.LLM}
SLOW = ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin")
SHUFFLE_FREE = (
    "std_full", "std_yes_no", "filt_range", "filt_levels", "miss_mean", "miss_mode", "miss_mixed_order", "out_cap",
    "out_remove", "scale_standard", "scale_robust", "enc_label", "enc_onehot", "feat_chain", "eda_scatter",
)


def explained(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("src_", "sink_"))])
def test_plan(spark, folder, capsys, name):
    plan = explained(QUERIES[name](spark, folder), capsys)
    assert not [word for word in SLOW if word in plan]
    if name in SHUFFLE_FREE:
        assert "Exchange" not in plan        # fitted parameters are literals


def test_filters_and_columns_reach_the_scan(spark, folder, capsys):
    lines = table(spark, folder, "lineitem")
    plan = explained(RowFilter("l_quantity", range=(1, 5)).apply(lines).select("l_orderkey"), capsys)
    assert "GreaterThanOrEqual(l_quantity,1.0)" in plan and "LessThanOrEqual(l_quantity,5.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    plan = explained(RowFilter("l_returnflag", levels=["A"]).apply(lines), capsys)
    assert "EqualTo(l_returnflag,A)" in plan or "In(l_returnflag" in plan


def test_filter_passes_below_the_fitted_steps(spark, folder, capsys):
    lines = table(spark, folder, "lineitem")
    fitted = Plan(scaling=("standard", ["l_tax"]), filter=RowFilter("l_quantity", range=(1, 5))).fit(lines)
    assert "LessThanOrEqual(l_quantity,5.0)" in explained(fitted.transform(lines), capsys)


def test_duplicates_need_no_window_and_no_join(spark, folder, capsys):
    plan = explained(duplicates.flag_duplicates(table(spark, folder, "orders")), capsys)
    assert "Window" not in plan and "Join" not in plan and "partial_count" in plan


def test_no_full_text_is_shuffled_to_count_distinct_values(spark, folder, capsys):
    plan = explained(QUERIES["prof_missing_documents"](spark, folder), capsys)
    assert "sha2" in plan
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and not [line for line in shuffled if "text#" in line or "value#" in line]


def test_distinct_counts_do_not_multiply_rows(spark, folder, capsys):
    plan = explained(profile.distinct_counts(table(spark, folder, "orders")), capsys)
    assert "Expand" not in plan


def test_distinct_counts_shuffle_words_of_bitmaps(spark, folder, capsys):
    """Numbers of all types share one lane, and 64 neighbours one row."""
    df = spark.range(64_000, numPartitions=2).selectExpr("id", "id % 2 = 0 as b", "cast(id % 10 as float) as d")
    plan = explained(profile.distinct_counts(df), capsys)
    assert "bit_or" in plan and "lane" not in plan


def test_preview_keeps_n_rows_per_task(spark, folder, capsys):
    assert "TakeOrderedAndProject" in explained(QUERIES["lim_preview"](spark, folder), capsys)
