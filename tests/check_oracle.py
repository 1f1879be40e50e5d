"""Run registered queries against their SQL: python tests/check_oracle.py [folder] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return [tuple(r) for r in zip(*columns)]


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float) and math.isnan(v):
        return (1, "")
    return (2, f"{v:020.6f}") if isinstance(v, (int, float)) and not isinstance(v, bool) else (3, str(v))


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1.1e-6)
    return type(a) is type(b) and a == b


def compare(spark_table, duck_table, strict: bool = False) -> str | None:
    """What differs, or None. Column names, types and all values, in any row order."""
    ours = {f.name: str(f.type) for f in spark_table.schema}
    theirs = {f.name: str(f.type) for f in duck_table.schema}
    if set(ours) != set(theirs):
        return f"columns {sorted(ours)} != {sorted(theirs)}"
    kinds = {n: (ours[n], theirs[n]) for n in ours if ours[n].replace("large_", "") != theirs[n].replace("large_", "")
             and "timestamp" not in ours[n]}
    if kinds:
        return f"types {kinds}"
    a, b = (sorted(_rows(t), key=lambda r: [_key(v) for v in r]) for t in (spark_table, duck_table))
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if strict and a != b:
        unequal = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
        if unequal:
            return f"{len(unequal)} rows equal only within rounding, such as {unequal[0]}"
    for x, y in zip(a, b):
        if not all(_same(u, v) for u, v in zip(x, y)):
            return f"{sorted(ours)}: {x} != {y}"
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        if name not in oracles:
            print(f"--- {name} has no SQL; its own tests hold it against brute force", flush=True)
            continue
        try:
            result = run(spark, folder).toArrow()
            took = time.time() - start
            problem = compare(result, con.sql(oracles[name]).to_arrow_table(), bool(os.environ.get("STRICT")))
        except Exception as e:  # report and go on with the next query
            took, problem = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {took:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) and 1)
