"""Intermediate tables: where they lie, who deletes them, and when."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from kempt.operators.staging import collecting, new_path, release, settled, staged, staging_root

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def tables(spark):
    return set(os.listdir(staging_root(spark)))


def test_they_lie_in_the_shared_folder(spark):
    assert staging_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_owners_release_what_they_made(spark):
    before = tables(spark)
    with collecting() as outer:
        with collecting() as inner:
            one = staged(spark.range(3), "one")
            os.makedirs(new_path(spark, "two"))
        assert len(inner) == 2 and outer == inner and one.count() == 3
    assert len(tables(spark) - before) == 2
    release(spark, outer)
    assert tables(spark) == before


def test_settled_keeps_the_result_only(spark):
    before = tables(spark)

    def build():
        return staged(staged(spark.range(5), "step").withColumn("x", F.col("id") * 2), "step").where("x > 2")

    with collecting() as made:
        out = settled(spark, build, "out")
    assert sorted(r["x"] for r in out.collect()) == [4, 6, 8]
    assert len(made) == 1 and [x.split("-")[0] for x in tables(spark) - before] == ["out"]
    release(spark, made)


def test_the_folder_goes_with_the_driver(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from kempt.operators.staging import staged, staging_root
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
staged(spark.range(3))
print(staging_root(spark))
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    folder = out.stdout.split()[-1]
    assert folder.startswith(f"{tmp_path}/kempt-") and not os.path.exists(folder), out.stderr[-500:]
