"""Shards by a hierarchical weighted hash tree.

The tree has regions of racks of shards; the weight of a rack or a region is the sum of its shards'. A row descends it: at
each level it draws ``-ln(u) / weight`` for each child of the node it has come to, u being a hash of the row's key, the
level and the child's number, and goes to the child with the least draw. So each child wins in proportion to its weight,
and a draw hangs on nothing but the key and that child's weight.

A changed weight changes the weights of the nodes above it and no others: rows move between regions only into or out of
the region that holds the shard, inside it only into or out of its rack, inside that only into or out of the shard.
Growth: an added shard opens a region of its own, so that no node that has rows changes its weight, and rows move only
into the added shard.

Everything is an expression over one row. Slots number the rows of a shard without gaps: rows are range-partitioned
by (shard, key), counted per (shard, partition), and numbered from the running sum of those few counts, so that no
task ever holds a whole shard. Texts are not shuffled, only their sizes and checksums.

Defined results: a null key draws like the text '' and is placed like any other; a null text has size 0 plus the
overhead, and checksum 0; rows with equal keys share a shard and get different slots; an empty table stays empty;
extra columns are left out. A weight of 0 keeps a shard empty; negative weights raise ValueError.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import staged, text_of

RACK_SHARDS = 5
REGION_RACKS = 4
OVERHEAD = 16
HEX_DIGITS = 12


def _draw(key: Column, level: str, node: Column, weight: Column) -> Column:
    digest = F.md5(F.concat(key, F.lit(f":{level}:"), node.cast("string")))
    u = (F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") + 0.5) / F.lit(float(16**HEX_DIGITS))
    return F.when(weight > 0, -F.log(u) / weight).otherwise(F.lit(float("inf")))


def _child(key: Column, level: str, parent: Column, weights: Sequence[Sequence[float]], width: int) -> Column:
    """The number, over the whole level, of the child that the row goes to; ``weights`` are by parent."""
    own = F.element_at(F.array(*[F.array(*[F.lit(float(w)) for w in ws]) for ws in weights]), parent + 1)
    draws = F.transform(own, lambda weight, i: _draw(key, level, parent * width + i, weight))
    # Written as a column of its own, the draws are computed once.
    return F.aggregate(
        F.array(draws), F.lit(-1), lambda _, d: (F.array_position(d, F.array_min(d)) - 1).cast("int")
    ) + parent * width


def _chunks(values: Sequence[float], width: int) -> list[list[float]]:
    return [list(values[i:i + width]) for i in range(0, len(values), width)]


def place(
    docs: DataFrame,
    weights: Sequence[float],
    rack_shards: int = RACK_SHARDS,
    region_racks: int = REGION_RACKS,
    key: str = "doc_id",
    added: Sequence[float] = (),
) -> DataFrame:
    """``doc_id, size, text_crc32`` and the row's ``region, rack, shard`` in a tree of the given shard weights; shards
    ``added`` to it later, by their weights, are regions of their own. Also ``draw``, the draw of the row's region."""
    every = [*weights, *added]
    if not every or min(every) < 0 or max(every) == 0:
        raise ValueError("weights must not be negative, and one must be positive")
    by_rack = _chunks(weights, rack_shards)
    racks = [sum(ws) for ws in by_rack]
    by_region = _chunks(racks, region_racks)
    regions = [*(sum(rs) for rs in by_region), *added]
    sized = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text_of()) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    region = _child(name, "region", F.lit(0), [regions], len(regions))
    at_region = sized.withColumn("region", region)
    # An added region is its shard; the others are descended.
    old = F.col("region") < len(by_region)
    held = F.least(F.col("region"), F.lit(max(len(by_region) - 1, 0)))
    rack = F.when(old, _child(name, "rack", held, by_region or [[1.0]], region_racks)).otherwise(
        F.col("region") + len(racks) - len(by_region))
    at_rack = at_region.withColumn("rack", rack)
    last = F.least(F.col("rack"), F.lit(max(len(racks) - 1, 0)))
    shard_ = F.when(old, _child(name, "shard", last, by_rack or [[1.0]], rack_shards)).otherwise(
        F.col("region") + len(weights) - len(by_region))
    heavy = F.element_at(F.array(*[F.lit(float(w)) for w in regions]), F.col("region") + 1)
    return at_rack.withColumn("shard", shard_).withColumn("draw", _draw(name, "region", F.col("region"), heavy))


def numbered(placed: DataFrame) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... within each shard in the order of (doc_id, text_crc32, size)."""
    order = ["doc_id", "text_crc32", "size"]
    # The partition number is stored with the rows, so a retried task cannot change it.
    ranged = staged(
        placed.repartitionByRange("shard", *order).withColumn("part", F.spark_partition_id()), "shards"
    )
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "part").orderBy(*order)
    return (
        ranged.withColumn("row", F.row_number().over(inside))
        .join(offsets, ["shard", "part"])
        .withColumn("slot", F.col("before") + F.col("row") - 1)
        .drop("part", "row", "before")
    )


def shard(
    docs: DataFrame, shards: int = 40, weights: Sequence[float] | None = None,
    rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS,
) -> DataFrame:
    """Place all rows in ``shards`` shards, number them, and tell where each goes when one more shard, of weight 1, is
    added: into it if its region's draw is less than that of the row's region, else nowhere else."""
    weights = [1.0] * shards if weights is None else list(weights)
    placed = place(docs, weights, rack_shards, region_racks)
    regions = -(-(-(-len(weights) // rack_shards)) // region_racks)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    joins = _draw(name, "region", F.lit(regions), F.lit(1.0)) < F.col("draw")
    grown = placed.withColumn("grown_shard", F.when(joins, len(weights)).otherwise(F.col("shard"))).drop("draw")
    # Written before rows are sorted, so that the draws are computed once.
    return numbered(staged(grown, "placed"))
