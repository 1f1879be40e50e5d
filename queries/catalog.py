"""The registered queries: each operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kempt.functions import text
from kempt.functions.columns import number
from kempt.functions.names import uniquify
from kempt.operators import explore, profile
from kempt.operators.derive import FeatureRule, apply_rules
from kempt.operators.duplicates import count_duplicates, handle_duplicates
from kempt.operators.encode import LabelEncode, OneHotEncode, SparseOneHot
from kempt.operators.filters import RowFilter, level_domain, numeric_domain
from kempt.operators.missing import handle_missing, strategies
from kempt.operators.numeric import Outliers, Scaling
from kempt.operators.staging import new_path
from kempt.operators.standardize import Standardize, rename_clean
from kempt.plans.plan import Plan
from kempt.sources.readers import load_table, read_csv, read_json
from kempt.sources.samples import load_sample
from kempt.sources.writers import dated_name, write_csv

from .inputs import dirty_customer, dirty_customer_dup, spiky_lineitem, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


# ---- sources and sinks -------------------------------------------------------------


@query
def src_sample(spark, folder):
    return load_sample(spark, folder, "TEST1")


@query
def src_dispatch(spark, folder):
    return load_table(spark, f"{folder}/part.parquet")


@query
def src_csv(spark, folder):
    path = new_path(spark, "part")
    table(spark, folder, "part").write.csv(path, header=True, escape='"')
    return read_csv(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def _documents(spark, folder, build, label) -> str:
    """Customers as JSON lines, up to 1000 customers in each document."""
    customers = table(spark, folder, "customer")
    rows = F.collect_list(F.struct(*customers.columns)).alias("rows")
    chunks = customers.groupBy(F.floor(F.col("c_custkey") / 1000).alias("chunk")).agg(rows)
    path = new_path(spark, label)
    chunks.select(F.to_json(build(customers.columns)).alias("value")).write.text(path)
    return path


@query
def src_json_records(spark, folder):
    path = _documents(spark, folder, lambda names: F.col("rows"), "records")
    return load_table(spark, path, "jsonl")


@query
def src_json_data(spark, folder):
    path = _documents(spark, folder, lambda names: F.struct(F.col("rows").alias("data")), "wrapped")
    return read_json(spark, path, lines=True)


@query
def src_json_columnar(spark, folder):
    arrays = lambda names: F.struct(*[F.col(f"rows.{n}").alias(n) for n in names])
    return read_json(spark, _documents(spark, folder, arrays, "columnar"), lines=True)


@query
def src_json_flatten(spark, folder):
    path = new_path(spark, "nested")
    table(spark, folder, "orders").select(
        "o_orderkey",
        F.struct(
            F.col("o_totalprice").alias("total"),
            F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("code")).alias("state"),
        ).alias("detail"),
    ).write.json(path)
    return rename_clean(read_json(spark, path, lines=True))


@query
def src_parquet(spark, folder):
    return load_table(spark, f"{folder}/supplier.parquet")


@query
def sink_csv_roundtrip(spark, folder):
    path = new_path(spark, "export")
    write_csv(dirty_customer(spark, folder), path)
    return read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


# ---- projections and text ----------------------------------------------------------


@query
def proj_clean_names(spark, folder):
    messy = table(spark, folder, "customer").toDF(" Cust Key ", "cust-key", "2nd", "***", "Mkt  Segment!")
    return rename_clean(messy)


@query
def proj_unique_names(spark, folder):
    suppliers = table(spark, folder, "supplier")
    return suppliers.toDF(*uniquify(["a", "a", "a_1", "a"]))


@query
def proj_drop_cols(spark, folder):
    return Plan(drop_columns=("all_null", "constant", "absent", "acctbal")).fit_transform(
        dirty_customer(spark, folder)
    ).cleaned


@query
def str_trim(spark, folder):
    return dirty_customer(spark, folder).select(
        "c_custkey", text.trimmed(F.col("segment")).alias("segment"), text.trimmed(F.col("active")).alias("active")
    )


@query
def std_missing_tokens(spark, folder):
    return dirty_customer(spark, folder).select(
        "c_custkey", *[text.without_missing_tokens(F.col(c)).alias(c) for c in ("segment", "active", "opinion")]
    )


@query
def std_yes_no(spark, folder):
    dirty = dirty_customer(spark, folder).select("c_custkey", "active", "opinion")
    return Standardize.fit(dirty).apply(dirty)


@query
def std_full(spark, folder):
    dirty = dirty_customer(spark, folder).drop("acctbal").withColumnRenamed("segment", " Segment ")
    return Standardize.fit(dirty).apply(dirty)


@query
def std_documents(spark, folder):
    """Whole texts."""
    documents = table(spark, folder, "documents")
    return Standardize.fit(documents).apply(documents)


@query
def num_safe_cast(spark, folder):
    dirty = dirty_customer(spark, folder)
    return dirty.select(
        "c_custkey", *[number(dirty.schema[c]).alias(c) for c in ("acctbal", "nation", "active", "in_credit")]
    )


# ---- filters -----------------------------------------------------------------------


@query
def filt_range(spark, folder):
    return RowFilter("acctbal", range=(0.0, 5000.0)).apply(dirty_customer(spark, folder)).select("c_custkey", "acctbal")


@query
def filt_range_lines(spark, folder):
    """A stored column: the range reaches the Parquet scan."""
    lines = RowFilter("l_extendedprice", range=(1000.0, 2000.0)).apply(table(spark, folder, "lineitem"))
    return lines.select("l_orderkey", "l_partkey", "l_extendedprice")


@query
def filt_levels(spark, folder):
    kept = RowFilter("o_orderpriority", levels=("1-URGENT", "5-LOW")).apply(table(spark, folder, "orders"))
    return kept.select("o_orderkey", "o_orderpriority")


@query
def filt_levels_boolean(spark, folder):
    kept = RowFilter("in_credit", levels=("TRUE",)).apply(dirty_customer(spark, folder))
    return kept.select("c_custkey", "in_credit")


@query
def filt_passthrough(spark, folder):
    df = dirty_customer(spark, folder).select("c_custkey", "nation", "segment")
    for row_filter in (
        RowFilter(), RowFilter("absent", range=(0, 1)), RowFilter("nation", range=(1,)),
        RowFilter("nation"), RowFilter("segment", levels=()),
    ):
        df = row_filter.apply(df)
    return df


@query
def filt_domain_num(spark, folder):
    return numeric_domain(dirty_customer(spark, folder), "acctbal", (-100.0, 99999.0))


@query
def filt_domain_cat(spark, folder):
    return level_domain(dirty_customer(spark, folder), "segment")


# ---- duplicates --------------------------------------------------------------------


@query
def dup_remove(spark, folder):
    return handle_duplicates(dirty_customer_dup(spark, folder), "remove").drop("acctbal")


@query
def dup_remove_few_columns(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return handle_duplicates(lines, "remove")


@query
def dup_flag(spark, folder):
    return handle_duplicates(dirty_customer_dup(spark, folder), "flag").drop("acctbal")


@query
def dup_flag_hot(spark, folder):
    """Three columns of few values: every set of equal rows is large."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return handle_duplicates(lines, "flag")


@query
def dup_keep(spark, folder):
    return handle_duplicates(dirty_customer_dup(spark, folder), "keep").drop("acctbal")


@query
def agg_dup_count(spark, folder):
    return count_duplicates(table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


# ---- missing cells -----------------------------------------------------------------

FILLED = ["c_custkey", "acctbal", "nation", "segment", "opinion", "in_credit"]


def _clean(spark, folder):
    dirty = dirty_customer(spark, folder)
    return Standardize.fit(dirty).apply(dirty)


@query
def miss_keep(spark, folder):
    return handle_missing(_clean(spark, folder), {"nation": "keep"}).select("c_custkey", "nation", "segment")


@query
def miss_drop_rows(spark, folder):
    return handle_missing(_clean(spark, folder), {"acctbal": "drop_rows"}).select("c_custkey", "acctbal")


@query
def miss_mean(spark, folder):
    filled = handle_missing(_clean(spark, folder), {"acctbal": "mean", "nation": "mean", "all_null": "mean"})
    return rounded(filled.select("c_custkey", "acctbal", "nation", "all_null"), 4, "acctbal", "nation")


@query
def miss_median(spark, folder):
    filled = handle_missing(_clean(spark, folder), {"acctbal": "median", "nation": "median", "all_null": "median"})
    return rounded(filled.select("c_custkey", "acctbal", "nation", "all_null"), 4, "acctbal", "nation")


@query
def miss_zero(spark, folder):
    filled = handle_missing(_clean(spark, folder), {"acctbal": "zero", "nation": "zero"})
    return filled.select("c_custkey", "acctbal", "nation")


@query
def miss_mode(spark, folder):
    filled = handle_missing(
        _clean(spark, folder), {"segment": "mode", "opinion": "mode", "in_credit": "mode"}, ["c_custkey"]
    )
    return filled.select("c_custkey", "segment", "opinion", "in_credit")


@query
def miss_label(spark, folder):
    filled = handle_missing(_clean(spark, folder), {"segment": "missing_label", "in_credit": "missing_label"})
    return filled.select("c_custkey", "segment", "in_credit")


MIXED = {"acctbal": "median", "nation": "drop_rows", "segment": "mode", "opinion": "drop_rows", "in_credit": "mode"}


@query
def miss_mixed_order(spark, folder):
    filled = handle_missing(_clean(spark, folder), MIXED, ["c_custkey"])
    return rounded(filled.select(*FILLED), 4, "acctbal")


# ---- profiles and statistics -------------------------------------------------------


@query
def prof_missing_cols(spark, folder):
    return profile.missing_columns(dirty_customer(spark, folder))


@query
def prof_missing(spark, folder):
    return profile.missing_profile(dirty_customer(spark, folder))


@query
def prof_missing_label(spark, folder):
    return profile.missing_labels(dirty_customer(spark, folder))


@query
def sort_missing(spark, folder):
    return profile.missing_order(dirty_customer(spark, folder))


@query
def prof_summary(spark, folder):
    return profile.summary_table(_clean(spark, folder), ["c_custkey"])


@query
def prof_summary_lines(spark, folder):
    return profile.summary_table(spiky_lineitem(spark, folder))


@query
def prof_missing_documents(spark, folder):
    return profile.missing_profile(table(spark, folder, "documents"))


@query
def prof_missing_embeddings(spark, folder):
    return profile.missing_profile(table(spark, folder, "embeddings"))


@query
def prof_summary_events(spark, folder):
    return profile.summary_table(table(spark, folder, "events"), ["event_id"])


@query
def agg_distinct(spark, folder):
    return profile.distinct_counts(spiky_lineitem(spark, folder))


@query
def agg_mode_first(spark, folder):
    return explore.mode_first(
        table(spark, folder, "orders"), ["o_orderpriority", "o_orderstatus", "o_custkey"], ["o_orderkey"]
    )


@query
def agg_mode_sorted(spark, folder):
    return explore.categorical_insight(table(spark, folder, "orders"), "o_custkey").select("mode", "mode_count")


@query
def agg_quantiles(spark, folder):
    found = explore.column_quantiles(
        spiky_lineitem(spark, folder), ["price", "discount", "l_quantity"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    )
    return rounded(found, 4, "value")


@query
def stats_quick(spark, folder):
    return profile.quick_stats(dirty_customer_dup(spark, folder))


@query
def stats_stage(spark, folder):
    return profile.stage_stats(table(spark, folder, "lineitem"))


@query
def stats_compare(spark, folder):
    stages = Plan(
        standardize=True, duplicates="remove", drop_columns=("all_null",),
        missing={"acctbal": "median", "nation": "drop_rows"}, order_by=("c_custkey",),
    ).fit_transform(dirty_customer_dup(spark, folder))
    return profile.compare_stages(dirty_customer_dup(spark, folder), stages.cleaned)


@query
def stats_overview(spark, folder):
    return profile.overview(spiky_lineitem(spark, folder))


@query
def stats_missing_warning(spark, folder):
    return profile.missing_warning(dirty_customer(spark, folder))


@query
def lim_preview(spark, folder):
    return profile.preview(table(spark, folder, "customer"), 12, ["c_custkey"])


# ---- preprocessing -----------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query
def out_cap(spark, folder):
    lines = spiky_lineitem(spark, folder).withColumn("constant", F.lit(1.0))
    capped = Outliers.fit(lines, "cap", ["price", "discount", "constant", "l_returnflag", "absent"]).apply(lines)
    return rounded(capped.select(*LINE_KEYS, "price", "discount", "constant"), 4, "price", "discount")


@query
def out_remove(spark, folder):
    lines = spiky_lineitem(spark, folder)
    kept = Outliers.fit(lines, "remove", ["price", "discount"]).apply(lines)
    return kept.select(*LINE_KEYS, "price", "discount")


def _scaled(spark, folder, method):
    lines = spiky_lineitem(spark, folder).withColumn("constant", F.lit(1.0))
    names = ["price", "discount", "constant"]
    scaled = Scaling.fit(lines, method, names).apply(lines)
    return rounded(scaled.select(*LINE_KEYS, *names), 6, *names)


@query
def scale_standard(spark, folder):
    return _scaled(spark, folder, "standard")


@query
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@query
def scale_robust(spark, folder):
    return _scaled(spark, folder, "robust")


@query
def enc_label(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return LabelEncode.fit(orders, ["o_orderpriority", "o_orderstatus"], ["o_orderkey"]).apply(orders)


@query
def enc_label_many(spark, folder):
    """One level per customer name: too many for a list inside the projection."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return LabelEncode.fit(customers, ["c_name"], ["c_custkey"]).apply(customers)


@query
def enc_label_documents(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    coded = LabelEncode.fit(documents, ["text", "lang", "source"], ["doc_id"]).apply(documents)
    return coded.select("doc_id", "text", "lang", "source")


@query
def enc_onehot(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return OneHotEncode.fit(orders, ["o_orderstatus", "o_orderpriority"], ["o_orderkey"]).apply(orders)


@query
def enc_onehot_missing(spark, folder):
    df = _clean(spark, folder).select("c_custkey", "active", "nation")
    return OneHotEncode.fit(df, ["active", "nation"], ["c_custkey"]).apply(df)


# ---- derived columns ---------------------------------------------------------------


def _feature(operation, col1, col2=None):
    def run(spark, folder):
        dirty = dirty_customer(spark, folder)
        rule = FeatureRule("feature", operation, col1, col2)
        return rounded(apply_rules(dirty, [rule]).select("c_custkey", "feature"), 6, "feature")

    return run


QUERIES |= {
    "feat_add": _feature("add", "acctbal", "nation"),
    "feat_subtract": _feature("subtract", "acctbal", "nation"),
    "feat_multiply": _feature("multiply", "acctbal", "nation"),
    "feat_divide": _feature("divide", "acctbal", "nation"),
    "feat_log": _feature("log", "acctbal"),
    "feat_square": _feature("square", "acctbal"),
    "feat_sqrt": _feature("sqrt", "acctbal"),
    "feat_abs": _feature("abs", "acctbal"),
}

CHAIN = [
    FeatureRule("net", "multiply", "l_extendedprice", "l_discount"),
    FeatureRule("per_unit", "divide", "net", "l_quantity"),
    FeatureRule("skipped", "add", "net", "absent"),
    FeatureRule("ignored", "cube", "net"),
    FeatureRule("log_unit", "log", "per_unit"),
    FeatureRule("net", "subtract", "net", "l_tax"),
]


@query
def feat_chain(spark, folder):
    lines = table(spark, folder, "lineitem").drop("l_shipdate", "l_linestatus")
    return rounded(apply_rules(lines, CHAIN), 6, "log_unit")


# ---- exploration -------------------------------------------------------------------


@query
def eda_insight_num(spark, folder):
    return explore.numeric_insight(spiky_lineitem(spark, folder), "price")


@query
def eda_insight_cat(spark, folder):
    return explore.insight(_clean(spark, folder), "segment")


@query
def eda_insight_all_missing(spark, folder):
    return explore.insight(dirty_customer(spark, folder), "all_null")


@query
def eda_kurtosis(spark, folder):
    return explore.kurtosis(spiky_lineitem(spark, folder), "price")


@query
def eda_corr(spark, folder):
    return explore.correlations(spiky_lineitem(spark, folder))


@query
def eda_corr_gaps(spark, folder):
    return explore.correlations(dirty_customer(spark, folder))


@query
def eda_bar_count(spark, folder):
    return explore.frequencies(dirty_customer(spark, folder), "nation")


@query
def eda_bar_turns(spark, folder):
    return explore.frequencies(table(spark, folder, "conversations"), "role")


@query
def eda_bar_agg(spark, folder):
    bars = explore.bar_totals(table(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice", "l_linestatus")
    return rounded(bars, 2, "sum", "mean")


@query
def eda_histogram(spark, folder):
    return rounded(explore.histogram(spiky_lineitem(spark, folder), "price"), 4, "bin_start", "bin_end")


@query
def eda_histogram_color(spark, folder):
    bars = explore.histogram(table(spark, folder, "events"), "value", 20, "event_type")
    return rounded(bars, 4, "bin_start", "bin_end")


@query
def eda_histogram_text(spark, folder):
    return explore.histogram(table(spark, folder, "part"), "p_brand")


@query
def eda_box(spark, folder):
    boxes = explore.box_summary(table(spark, folder, "events"), "value", "event_type")
    return rounded(boxes, 4, *[c for c in boxes.columns if c not in ("group", "n", "outliers")])


@query
def eda_box_all(spark, folder):
    boxes = explore.box_summary(spiky_lineitem(spark, folder), "price")
    return rounded(boxes, 4, *[c for c in boxes.columns if c not in ("group", "n", "outliers")])


@query
def eda_box_outliers(spark, folder):
    return explore.box_outliers(table(spark, folder, "events"), "value", "event_type")


@query
def eda_violin(spark, folder):
    violins = explore.violin_summary(table(spark, folder, "events"), "value", "event_type", 20)
    return rounded(violins, 6, "bin_start", "bin_end", "density", "q1", "median", "q3", "mean")


@query
def eda_scatter(spark, folder):
    return explore.scatter_points(dirty_customer(spark, folder), "acctbal", "nation", "opinion")


@query
def eda_trend(spark, folder):
    lines = explore.trend_line(spiky_lineitem(spark, folder), "l_quantity", "price")
    return rounded(lines, 4, "slope", "intercept")


# ---- whole plans -------------------------------------------------------------------

CLEANING = Plan(
    standardize=True, duplicates="remove", drop_columns=("constant",),
    missing={"acctbal": "median", "nation": "mean", "segment": "mode", "opinion": "missing_label"},
    order_by=("c_custkey",),
)


@query
def chain_clean(spark, folder):
    stages = CLEANING.fit_transform(dirty_customer_dup(spark, folder))
    return profile.summary_table(stages.cleaned, ["c_custkey"])


@query
def chain_preprocess(spark, folder):
    plan = Plan(
        outlier=("cap", ["price"]), scaling=("standard", ["price"]),
        encoding=("label", ["l_returnflag"]),
    )
    done = plan.fit_transform(spiky_lineitem(spark, folder)).preprocessed
    return rounded(done.select(*LINE_KEYS, "price", "l_returnflag"), 6, "price")


FULL = Plan(
    standardize=True, duplicates="remove", drop_columns=("all_null", "constant"),
    missing={"acctbal": "median", "nation": "drop_rows", "segment": "mode", "in_credit": "mode"},
    outlier=("remove", ["acctbal"]), scaling=("minmax", ["acctbal"]), encoding=("onehot", ["active"]),
    features=(FeatureRule("score", "multiply", "acctbal", "nation"), FeatureRule("log_score", "log", "score")),
    filter=RowFilter("acctbal", range=(0.1, 0.9)), order_by=("c_custkey",),
)


@query
def chain_full(spark, folder):
    done = FULL.fit_transform(dirty_customer_dup(spark, folder)).filtered
    return rounded(done, 6, "acctbal", "score", "log_score")


@query
def chain_refit(spark, folder):
    """A plan fitted on the table with copies, applied to the table without."""
    fitted = FULL.fit(dirty_customer_dup(spark, folder))
    return rounded(fitted.transform(dirty_customer(spark, folder)), 6, "acctbal", "score", "log_score")


# ---- files that differ, refusals, exports --------------------------------------------


@query
def src_csv_files(spark, folder):
    """Plain files, some with cells over two lines, some with a stray quote, and one with a cell and a quote of these."""
    path = new_path(spark, "parts")
    parts = table(spark, folder, "part")
    mixed = F.col("p_partkey").isin(1, 2)
    for k, (name, ending, options) in enumerate((
        ("plain", "", {}), ("spanning", "\nmore", {}), ("stray", ' 5" pipe', {"quote": "\u0000"}),
    )):
        some = parts.where((F.col("p_partkey") % 3 == k) & ~mixed)
        some = some.select("p_partkey", F.concat("p_name", F.lit(ending)).alias("p_name"))
        some.write.csv(f"{path}/{name}", header=True, escape='"', **options)
    cell = F.when(F.col("p_partkey") == 1, F.concat(F.lit('"'), "p_name", F.lit('\nmore"'))).otherwise(
        F.concat("p_name", F.lit(' 5" pipe'))
    )
    lines = F.sort_array(F.collect_list(F.concat_ws(",", F.col("p_partkey").cast("string"), cell)))
    header = F.lit("p_partkey,p_name")
    parts.where(mixed).agg(F.concat_ws("\n", header, lines)).write.text(f"{path}/mixed")
    return read_csv(spark, f"{path}/*").withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query
def src_csv_spanning(spark, folder):
    """Documents, whose texts hold line ends, commas and quotes, under a header with a quote; files stay split."""
    path = new_path(spark, "texts")
    docs = table(spark, folder, "documents").select("doc_id", "text", F.col("n_chars").alias("5\" size"))
    write_csv(docs, path)
    return read_csv(spark, path).select(F.col("doc_id").cast("bigint"), "text", F.col("5\" size").cast("bigint").alias("n_chars"))


@query
def src_csv_names(spark, folder):
    """Folders and files whose names hold blanks, percent signs, brackets and umlauts; repeated names in the header."""
    path = new_path(spark, "names")
    some = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", F.col("s_suppkey").alias("s_suppkey"))
    names = ["my data (1)", "50%25 off%20", "größe [é]"]
    for k, name in enumerate(names):
        some.where(F.col("s_nationkey") % 3 == k).write.csv(f"{path}/{name}", header=True)
    parts = [read_csv(spark, f"{path}/{name}") for name in names]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).toDF(*uniquify(parts[0].columns)).select(
        F.col("s_suppkey").cast("bigint"), "s_nationkey", F.col("s_suppkey_1").cast("bigint")
    )


@query
def src_json_files(spark, folder):
    """Many files, each one array of up to 100 records; every other file lacks a member."""
    path = new_path(spark, "files")
    chunk = F.floor(F.col("c_custkey") / 100)
    customers = table(spark, folder, "customer").withColumn("chunk", chunk).withColumn(
        "c_mktsegment", F.when(F.col("chunk") % 2 == 0, F.col("c_mktsegment"))
    )
    record = F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    chunks = customers.groupBy("chunk").agg(F.to_json(F.collect_list(record)).alias("value"))
    chunks.repartition("chunk").write.partitionBy("chunk").text(path)
    return read_json(spark, f"{path}/*").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query
def src_json_line_records(spark, folder):
    """Lines with a member ``data`` among others are records and keep all members."""
    path = new_path(spark, "lines")
    table(spark, folder, "orders").select(
        "o_orderkey", F.array(F.struct(F.col("o_orderstatus").alias("code"))).alias("data")
    ).write.json(path)
    return read_json(spark, path, lines=True).select("o_orderkey", F.col("data")[0]["code"].alias("code"))


def _large(spark, folder, name, key, head, tail) -> str:
    """Files that are one JSON document each, of 2,000 rows of a table, written line by line."""
    path = new_path(spark, "documents")
    rows = table(spark, folder, name)
    chunked = rows.select(F.floor(F.col(key) / 2000).alias("chunk"), key, F.to_json(F.struct(*rows.columns)).alias("value"))
    # The window brings each file's rows together and in order; nothing after it may move them.
    order = Window.partitionBy("chunk").orderBy(key)
    begin = F.when(F.lag(key).over(order).isNull(), head).otherwise(",")
    end = F.when(F.lead(key).over(order).isNull(), tail).otherwise("")
    chunked.select("chunk", F.concat(begin, "value", end).alias("value")).write.partitionBy("chunk").text(path)
    return f"{path}/*"


@query
def src_json_large(spark, folder):
    """Documents in files of one array each; those over 64 KiB are split into their records."""
    path = _large(spark, folder, "documents", "doc_id", "[", "]")
    return read_json(spark, path, largest=1 << 16).select("doc_id", "text", "lang", "n_chars")


@query
def src_json_large_data(spark, folder):
    """Pages under ``data``, between other members."""
    path = _large(spark, folder, "pages", "page_id", '{"about": [{"data": [{"a": "}"}]}], "data": [', '], "end": {"ok": true}}')
    return read_json(spark, path, largest=1 << 16).select("page_id", "url", "html")


@query
def src_json_refused(spark, folder):
    """JSON scalars are no table: the number of lines, and that reading them was refused."""
    path = new_path(spark, "scalars")
    table(spark, folder, "orders").select(F.col("o_orderkey").cast("string")).write.text(path)
    try:
        read_json(spark, path, lines=True)
        refused = False
    except ValueError:
        refused = True
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("rows")).withColumn("refused", F.lit(refused))


@query
def sink_dated(spark, folder):
    name = dated_name(date(2024, 3, 9))
    path = f"{new_path(spark, 'export')}/{name}"
    write_csv(table(spark, folder, "supplier"), path)
    return load_table(spark, path).withColumns({
        "s_suppkey": F.col("s_suppkey").cast("bigint"), "file": F.lit(name)
    })


@query
def sink_featured(spark, folder):
    """The export is the featured table, not the filtered one."""
    path = new_path(spark, "export")
    plan = Plan(features=(FeatureRule("twice", "add", "nation", "nation"),), filter=RowFilter("nation", range=(1, 5)))
    write_csv(plan.fit_transform(dirty_customer(spark, folder).select("c_custkey", "nation")).featured, path)
    return read_csv(spark, path, schema="c_custkey bigint, nation int, twice double")


# ---- menus, rules, points ------------------------------------------------------------


@query
def miss_menu(spark, folder):
    """The strategies that each column with gaps can choose from."""
    dirty = dirty_customer(spark, folder)
    menu = F.create_map(*[F.lit(x) for f in dirty.schema for x in (f.name, ", ".join(strategies(f.dataType)))])
    return profile.missing_columns(dirty).select("column", "missing", menu[F.col("column")].alias("menu"))


@query
def feat_rules(spark, folder):
    """Rules added twice under one name, one removed, the name used again."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    plan = Plan().add_feature(customers.schema, "add", "c_acctbal", "c_nationkey", "Total")
    plan = plan.add_feature(customers.schema, "subtract", "c_acctbal", "c_nationkey", "Total").remove_feature(0)
    plan = plan.add_feature(customers.schema, "multiply", "total_2", "c_nationkey", "Total")
    left = len(plan.reset_features().features)
    done = plan.fit(customers).transform(customers).select("c_custkey", "total", "total_2")
    return rounded(done, 2, "total", "total_2").withColumn("after_reset", F.lit(left))


@query
def feat_case(spark, folder):
    """Names that differ in case only are one column."""
    rules = (FeatureRule("Net", "add", "C_ACCTBAL", "c_nationkey"), FeatureRule("net", "multiply", "NET", "c_nationkey"))
    done = apply_rules(table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), rules)
    return rounded(done.select("c_custkey", F.col("Net").alias("net")), 2, "net")


@query
def eda_points(spark, folder):
    """Whether a pair of columns has points to draw."""
    dirty = dirty_customer(spark, folder)
    pairs = [("acctbal", "nation"), ("acctbal", "all_null")]
    flags = [F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(explore.has_points(dirty, x, y)).alias("drawn")) for x, y in pairs]
    return dirty.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(F.array(*flags)), "rows")


@query
def filt_level_selection(spark, folder):
    """The levels, and which of them a selection that names one level too many keeps."""
    return level_domain(dirty_customer(spark, folder), "opinion", ["maybe", "yes", "absent"])


# ---- exact identity, one order of levels ---------------------------------------------


@query
def agg_distinct_nested(spark, folder):
    """Lists and structs whose texts look alike count apart; so do vectors."""
    orders = table(spark, folder, "orders").selectExpr(
        """case o_orderkey % 4 when 0 then array('a, b') when 1 then array('a', 'b') when 2 then array(cast(null as string))
           else array('null') end as list""",
        "struct(case when o_orderkey % 2 = 0 then 'x, y' else 'x' end as l, case when o_orderkey % 2 = 0 then 'z' else 'y, z' end as r) as pair",
        "o_orderstatus",
    )
    vectors = table(spark, folder, "embeddings").select("embedding")
    return profile.distinct_counts(orders).unionByName(profile.distinct_counts(vectors))


@query
def enc_label_null_keys(spark, folder):
    """Levels are numbered by a key that can be missing or NaN: missing first, NaN last, then by level."""
    dirty = dirty_customer(spark, folder).selectExpr(
        "c_custkey", "concat('n', nation) as level",
        "case when nation % 5 = 0 then null when nation % 7 = 0 then cast('NaN' as double) else acctbal end as key",
    )
    return LabelEncode.fit(dirty, ["level"], ["key"]).apply(dirty).select("c_custkey", "level")


@query
def enc_label_refit(spark, folder):
    """Fitted where one customer has few orders, applied where a level that was rare holds a third of the rows."""
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", "o_custkey", "concat('c', o_custkey % 100) as level")
    skewed = orders.withColumn("level", F.when(F.col("o_orderkey") % 3 == 0, F.lit("c7")).otherwise(F.col("level")))
    return LabelEncode.fit(orders.where("o_custkey % 100 < 90"), ["level"]).apply(skewed).select("o_orderkey", "level")


@query
def enc_onehot_many(spark, folder):
    """Over 200 levels, which no default refuses."""
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", "concat('k', o_orderkey % 230) as v")
    return OneHotEncode.fit(orders, ["v"]).apply(orders)


@query
def enc_onehot_sparse(spark, folder):
    """Whole texts as levels: nearly as many indicators as rows, listed instead of spread over columns."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    fitted = SparseOneHot.fit(documents, ["source", "lang", "text"], ["doc_id"])
    return fitted.apply(documents).select(
        "doc_id", F.array_join("onehot", ",").alias("active"), F.lit(fitted.width).cast("bigint").alias("width")
    )
