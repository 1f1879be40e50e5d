"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from queries.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "std_full", "dup_remove", "dup_flag", "miss_mixed_order", "prof_missing", "prof_summary_lines", "agg_distinct",
    "agg_mode_first", "agg_quantiles", "stats_quick", "out_cap", "out_remove", "scale_standard", "scale_robust",
    "enc_label", "enc_label_many", "enc_onehot", "feat_chain", "filt_range", "eda_insight_num", "eda_corr",
    "eda_histogram", "eda_box", "eda_scatter", "src_csv", "sink_csv_roundtrip", "chain_clean", "chain_full",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Untimed: each query once on the smallest tables, to compile its code.
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(small) else []:
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
