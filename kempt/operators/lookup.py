"""Attach a dictionary (one row per key) to a table, whatever its size or skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.names import free_name

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_KEYS = 1_000     # the keys with most rows are hot: every key with over 1/1000 of the rows is among them
SALTS = 1_000
ROW_BYTES = 32       # of a broadcast row beside its key and payload
KEY_BYTES = 4_096    # longer keys are never treated as hot


def attach(
    df: DataFrame,
    key: Column,
    dictionary: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Left-join ``dictionary(key, n, <payload>)`` on ``key``; n = rows that held the key when it was made.

    A dictionary whose ``size`` in bytes is small is broadcast; the size is measured where it is not given. A larger
    one is shuffled, except for the ``HOT_KEYS`` most frequent keys of ``df``, which are broadcast; the rows they serve
    are salted so that they spread over all tasks of the shuffle. A stream cannot be counted ahead, so there the keys
    that were frequent before stand in. The payload's names must be free in ``df``.
    """
    payload = [c for c in dictionary.columns if c not in ("key", "n")]
    taken = [*df.columns, *payload]
    name = lambda label: free_name(f"{label}_of_lookup", taken)
    own, k, hot_flag, salt, rest_key, s = map(name, ("key", "k", "hot", "salt", "rest", "s"))
    if size is None:
        row = F.coalesce(F.octet_length(F.col("key").cast("string")), F.lit(0)) + ROW_BYTES + 16 * len(payload)
        size = dictionary.agg(F.sum(row)).first()[0]
    keyed = df.withColumn(own, key)
    small = dictionary.select(F.col("key").alias(k), *payload)
    if (size or 0) <= broadcast_bytes:
        return keyed.join(F.broadcast(small), F.col(own).eqNullSafe(F.col(k)), "left").drop(own, k)

    if df.isStreaming:
        counts = dictionary.select(F.col("key").alias(k), "n")
    else:
        counts = keyed.groupBy(F.col(own).alias(k)).agg(F.count(F.lit(1)).alias("n"))
    # Keys of bounded length; each task passes on at most HOT_KEYS of them.
    brief = F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) <= KEY_BYTES
    often = counts.where(brief).orderBy(F.desc("n")).limit(HOT_KEYS).select(k)
    found = often.join(
        dictionary.select(F.col("key").alias(s), *[F.col(c).alias(f"{hot_flag}_{c}") for c in payload]),
        F.col(k).eqNullSafe(F.col(s)), "left",
    ).drop(s).withColumn(hot_flag, F.lit(True))
    rest = dictionary.select(F.col("key").alias(k), F.lit(0).alias(s), *payload)
    served = keyed.join(F.broadcast(found), F.col(own).eqNullSafe(F.col(k)), "left").drop(k)
    salted = served.withColumn(
        salt, F.when(F.col(hot_flag), F.spark_partition_id() % SALTS + 1).otherwise(F.lit(0))
    ).withColumn(rest_key, F.when(F.col(hot_flag).isNull(), F.col(own)))
    joined = salted.join(rest, F.col(rest_key).eqNullSafe(F.col(k)) & (F.col(salt) == F.col(s)), "left")
    picked = [F.when(F.col(hot_flag), F.col(f"{hot_flag}_{c}")).otherwise(F.col(c)).alias(c) for c in payload]
    return joined.select(*[col(c) for c in df.columns], *picked)
