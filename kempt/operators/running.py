"""Running totals over sorted data of any size.

A window ordered over a whole table (or over one huge group) would run in a single
task. Here the rows are range-partitioned by group and order, so that even one group
spreads over many tasks; only one total per (partition, group) is accumulated globally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .staging import staged

ROWS_PER_TASK = 1_000_000


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    weight: Column | None = None,
    rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``before``: the sum of ``weight`` over earlier rows of the same group.

    ``order`` must be unique within a group. Column names of ``df`` are simple names.
    """
    weight = F.lit(1) if weight is None else weight
    weighed = df.withColumn("_w", weight.cast("bigint"))
    rows = df.count() if rows is None else rows
    if rows <= rows_per_task:
        # Small enough for one task: a plain window.
        past = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return weighed.withColumn("before", F.coalesce(F.sum("_w").over(past), F.lit(0))).drop("_w")
    parts = -(-rows // rows_per_task)
    # The partition number is stored with the rows: a retried task cannot change it.
    ranged = staged(
        weighed.repartitionByRange(parts, *group, *order).withColumn(
            "_part", F.spark_partition_id()
        ),
        "ranged",
    )
    keys = ["_part", *group]
    # At most one row per partition and group; earlier partitions hold earlier rows.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy(*keys)
        .agg(F.sum("_w").alias("_total"))
        .withColumn("_offset", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_offset")
    )
    matches = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    # A (partition, group) slice is no larger than one range partition.
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    joined = ranged.join(offsets, on=matches, how="inner")
    before = F.col("_offset") + F.coalesce(F.sum("_w").over(inside), F.lit(0))
    return joined.withColumn("before", before).select(*df.columns, "before")
