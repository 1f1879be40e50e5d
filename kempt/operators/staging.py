"""Where intermediate tables go, and how they are cut from their lineage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_marked: set[str] = set()


def staging_root(spark: SparkSession) -> str:
    """This application's folder in the shared one that the cluster names in ``spark.checkpoint.dir``.

    Where that is not set (tests, laptops), it lies in the warehouse, which a cluster shares as well. What is left in it
    goes when the driver ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    root = f"{shared.rstrip('/')}/kempt-{spark.sparkContext.applicationId}"
    if root not in _marked:
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        folder = jvm.org.apache.hadoop.fs.Path(root)
        system = folder.getFileSystem(conf)
        system.mkdirs(folder)
        system.deleteOnExit(folder)
        _marked.add(root)
    return root


_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The folders made inside the block, for their owner to release."""
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield paths
    finally:
        _owned.reset(token)
        outer = _owned.get()
        if outer is not None:
            outer.extend(paths)


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged tables, wherever the shared folder is. Tables that read them cannot be used afterwards."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """``staged(build())``; then what ``build`` itself has staged on the way is deleted.

    Driver garbage is collected too: Spark deletes shuffle files when their plan is, and a long chain of steps would
    otherwise hold those of all its steps on the executors' disks.
    """
    steps: list[str] = []
    token = _owned.set(steps)
    try:
        built = build()
    finally:
        _owned.reset(token)
    done = staged(built, label)
    del built
    release(spark, steps)
    spark._jvm.System.gc()
    return done


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The result survives the loss of any executor, and later scans read only the
    columns they need. Columns are stored by position, so names are free.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    stored = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    stored.write.parquet(path)
    return spark.read.schema(stored.schema).parquet(path).toDF(*df.columns)
