"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.staging import staged

ROWS_AT_ONCE = 1_000
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

__all__ = ["documents", "free", "map_texts", "staged", "text_of", "texts"]


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; a null is the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id, text`` and named others; extra columns, whatever their names, are left out."""
    return docs.select("doc_id", F.col("text"), *others)


def free(label: str) -> str:
    """A column name that no table of a user holds."""
    return f"_{label}_{uuid.uuid4().hex[:12]}"


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """Gives back what the C library keeps of freed memory, where it can."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return lambda _: 0


def map_texts(
    df: DataFrame, schema: T.StructType | str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``mapInArrow`` over the rows of ``df``: each task streams its batches, cut small, through ``work``.

    Workers live on between tasks and stages, so a task gives back what its allocators hold. Executors and workers
    hold a batch each per task: it is bounded by bytes, unless the session says how large batches are.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH, None) is None:
        conf.set(BATCH, BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))
        finally:
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return df.mapInArrow(run, schema)
