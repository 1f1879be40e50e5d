import pytest
from pyspark.sql import functions as F

from kempt.operators import lookup


@pytest.mark.parametrize("broadcast_bytes", [lookup.BROADCAST_BYTES, 0])
def test_attach(spark, broadcast_bytes, monkeypatch):
    """One key and the missing key hold most rows; with 0 bytes nothing fits a broadcast."""
    monkeypatch.setattr(lookup, "HOT_KEYS", 5)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, `the key` string, other int").repartition(6)
    sizes: dict = {}
    for _, k, _ in rows:
        sizes[k] = sizes.get(k, 0) + 1
    codes = {k: i for i, k in enumerate(sizes) if k != "k2"}
    table = spark.createDataFrame([(k, sizes[k], c) for k, c in codes.items()], "key string, n bigint, code int")
    got = lookup.attach(df, F.col("`the key`"), table, broadcast_bytes)
    assert got.columns == ["id", "the key", "other", "code"]
    assert {(r["id"], r["code"]) for r in got.collect()} == {(i, codes.get(k)) for i, k, _ in rows}
