"""Placement against a plain computation; growth, slots, weights and odd rows."""

import hashlib
import math
from collections import Counter

import pytest

from kempt.llm import shard_tree


def draw(key, level, node, weight):
    u = (int(hashlib.md5(f"{key}:{level}:{node}".encode()).hexdigest()[:12], 16) + 0.5) / 16**12
    return -math.log(u) / weight if weight else math.inf


def brute(key, weights, added=(), per_rack=5, per_region=4):
    """Region, rack and shard by descending one level after the other."""
    racks = [weights[i:i + per_rack] for i in range(0, len(weights), per_rack)]
    regions = [racks[i:i + per_region] for i in range(0, len(racks), per_region)]
    heavy = [sum(map(sum, r)) for r in regions] + list(added)
    region = min(range(len(heavy)), key=lambda i: draw(key, "region", i, heavy[i]))
    if region >= len(regions):
        return region, len(racks) + region - len(regions), len(weights) + region - len(regions)
    first = region * per_region
    rack = first + min(range(len(regions[region])), key=lambda i: draw(key, "rack", first + i, sum(racks[first + i])))
    first = rack * per_rack
    return region, rack, first + min(range(len(racks[rack])), key=lambda i: draw(key, "shard", first + i, racks[rack][i]))


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(
        [(i, None if i % 9 == 0 else "é" * (i % 7), "x", 5) for i in range(600)] + [(7, "twin", "x", 5)] * 2 + [(None, "", "y", 1)],
        "doc_id bigint, text string, shard string, slot int",
    )
    return shard_tree.shard(df, 40).collect()


def test_like_a_plain_computation(rows):
    assert len(rows) == 603
    for r in rows:
        key = "" if r["doc_id"] is None else r["doc_id"]
        assert (r["region"], r["rack"], r["shard"]) == brute(key, [1] * 40)
        assert r["grown_shard"] == brute(key, [1] * 40, [1])[2]
        assert r["rack"] == r["shard"] // 5 and r["region"] == r["shard"] // 20


def test_growth_moves_rows_only_into_the_new_shard(rows):
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert moved and {r["grown_shard"] for r in moved} == {40}


def test_slots_have_no_gaps(rows):
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_movement_is_confined_to_subtrees_whose_weights_change(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'' as text")
    at = lambda weights, **more: {r["doc_id"]: (r["region"], r["rack"], r["shard"]) for r in shard_tree.place(df, weights, **more).collect()}
    weights = [1.0 + s % 3 for s in range(37)]
    before = at(weights)
    assert all(before[k] == brute(k, weights) for k in range(0, 4000, 7))
    for changed, weight in ((7, 0.25), (7, 9.0), (36, 0.0)):
        after = at([weight if s == changed else w for s, w in enumerate(weights)])
        moved = [(before[k], after[k]) for k in before if before[k] != after[k]]
        # By level, one side of each move is the subtree whose weight has changed.
        path = (changed // 20, changed // 5, changed)
        side = 0 if weight < weights[changed] else 1
        assert moved
        for move in moved:
            level = next(i for i in range(3) if move[0][i] != move[1][i])
            assert move[side][level] == path[level]


def test_shards_added_one_after_the_other(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "'' as text")
    at = lambda added: {r["doc_id"]: r["shard"] for r in shard_tree.place(df, [1.0] * 13, added=added).collect()}
    steps = [at([]), at([2.0]), at([2.0, 1.0])]
    for k, (old, new) in enumerate(zip(steps, steps[1:], strict=False)):
        assert {new[i] for i in old if old[i] != new[i]} == {13 + k}
    assert abs(Counter(steps[2].values())[13] - 3000 * 2 / 16) < 100


def test_bad_weights_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert shard_tree.shard(empty).collect() == []
    for weights in ([], [0.0], [1.0, -1.0]):
        with pytest.raises(ValueError):
            shard_tree.place(empty, weights)
