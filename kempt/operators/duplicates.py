"""Whole-row duplicates: null equals null, NaN equals NaN, in every column.

Equal rows cannot be told apart, so which copy counts as the first is unobservable and
no ordering is needed. To remove or flag copies is one grouping by all columns; copies collapse
before the shuffle, so a row that makes up a third of the table costs no more than any.
To count them is a grouping by hashes, and one by all columns of the rows whose hash occurs again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.names import free_name
from .staging import staged

# Fixed value: the name of the flag column.
FLAG = "duplicate_flag"
COPIES_PER_TASK = 1_000_000
# Hashes of 8 bytes that are broadcast.
HASHES = 1_000_000


def remove_duplicates(df: DataFrame) -> DataFrame:
    return df.distinct()


def counted_copies(df: DataFrame) -> tuple[DataFrame, str]:
    """Each different row once, with the number of its copies in a new column, named second."""
    copies = free_name("copies", df.columns)
    return df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(copies)), copies


def flag_duplicates(df: DataFrame, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Add ``duplicate_flag``: false on one row of each set of equal rows, true on the rest."""
    counted, copies = counted_copies(df)
    copy, start = free_name("copy", counted.columns), free_name("start", counted.columns)
    kept = [col(c) for c in df.columns if c != FLAG]

    # Most rows have few copies: write them out where they are.
    few = counted.where(F.col(copies) <= copies_per_task).select(
        *kept,
        F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy),
    )
    # A hot row first becomes blocks of copies, which are spread over the tasks.
    block = F.explode(F.sequence(F.lit(0), F.col(copies) - 1, F.lit(copies_per_task).cast("bigint")))
    blocks = counted.where(F.col(copies) > copies_per_task).select("*", block.alias(start))
    many = blocks.repartition(*[col(c) for c in df.columns], F.col(start)).select(
        *kept,
        F.explode(
            F.sequence(
                F.col(start) + 1,
                F.least(F.col(start) + copies_per_task, F.col(copies)),
            )
        ).alias(copy),
    )
    return few.unionByName(many).select(*kept, (F.col(copy) > 1).alias(FLAG))


def row_hash(df: DataFrame) -> Column:
    """64 bits that equal rows share; different rows may share them too.

    Maps and collated texts are left out, since equal ones may differ in order or in letters.
    """
    plain = [f for f in df.schema.fields if not re.search("map<|collate", f.dataType.simpleString().lower())]
    return F.xxhash64(F.lit(0), *[c for f in plain for c in (col(f.name), col(f.name).isNull())])


def hash_counts(df: DataFrame, name: str, hashed: Callable[[DataFrame], Column] = row_hash) -> DataFrame:
    """``name``, the hash of a row, and the number ``n`` of rows that share it."""
    return df.select(hashed(df).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def repeated_rows(
    df: DataFrame, hashed: Callable[[DataFrame], Column] = row_hash, hashes: int = HASHES
) -> tuple[DataFrame, str]:
    """``counted_copies`` of all rows that occur again, and maybe of some others.

    Rows are grouped by their hashes first, so only 8 bytes of each are shuffled; whole rows are compared only where a hash
    occurs again. With more than ``hashes`` such hashes, too many to broadcast, all rows are compared.
    """
    mark = free_name("hash", [*df.columns, "n"])
    again = staged(hash_counts(df, mark, hashed).where("n > 1").select(mark), "repeated")
    if again.count() > hashes:
        return counted_copies(df)
    return counted_copies(df.withColumn(mark, hashed(df)).join(F.broadcast(again), mark, "left_semi").drop(mark))


def count_duplicates(df: DataFrame) -> DataFrame:
    """One row: ``duplicates`` = rows equal to an earlier row."""
    counted, copies = repeated_rows(df)
    return counted.agg(F.coalesce(F.sum(F.col(copies) - 1), F.lit(0)).alias("duplicates"))


def handle_duplicates(df: DataFrame, action: str) -> DataFrame:
    if action == "keep":
        return df
    if action == "remove":
        return remove_duplicates(df)
    if action == "flag":
        return flag_duplicates(df)
    raise ValueError(f"unknown duplicate action: {action!r}")
