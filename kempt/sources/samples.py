"""Named sample tables: Parquet files in one folder, found by name or alias."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DEFAULT = "customer"

# Short names for the sample tables.
ALIASES = {
    "test1": "customer",
    "test2": "part",
    "test3": "nation",
    "customer": "customer",
    "orders": "orders",
    "lineitem": "lineitem",
    "part": "part",
    "supplier": "supplier",
    "nation": "nation",
    "region": "region",
    "events": "events",
}


def sample_name(name: str | None, aliases: Mapping[str, str] = ALIASES, default: str = DEFAULT) -> str:
    """Names ignore case; an unknown or missing name means the default table."""
    return aliases.get((name or "").lower(), default)


def load_sample(spark: SparkSession, folder: str, name: str | None = None, **names) -> DataFrame:
    return spark.read.parquet(f"{folder}/{sample_name(name, **names)}.parquet")
