"""N-gram Jaccard join by PartEnum signatures, and the groups that its links form.

A document's set is that of its 5-word shingles (64-bit hashes). Two documents link when the Jaccard similarity of
their sets is 0.75 or more. Such sets differ in at most a third of the elements of either, and their sizes differ by a
third at most. So per band of sizes (doubling; a set near the upper edge also joins the next band) the shingle domain
is parted into P parts, and a set's signatures are the contents of single parts, enumerated over the parts. Two linking
sets x, y differ in at most k(x) and k(y) parts, k being a third of the size; all other parts are equal. Signatures have
a fixed order, so it is enough that each set gives its first k + 1: if the sets share all but k parts, their first k + 1
share one (what precedes it in one set but not in the other must be among the k). The order puts parts with many
shingles that are not common first, so a signature is rarely shared by chance and empty parts hardly ever come up. Common
shingles (met twice within some block of documents, so also those of passages that stand in one of thousands) are found
over all data; which of them the bounded list holds steers the order only, never the result.

Skew. Documents with equal sets are one node. A signature that many nodes share gives each of them two candidates: the
least node and the one before it. Candidates pass a bound from small histograms, then an exact comparison of the sets;
links give components. Only then, for signatures whose nodes are still in different components, the pairs between
components are taken: from groups of up to ``GROUP`` nodes by a join; from larger ones, which overlap in families of
near copies, by comparing blocks of ``BLOCK_NODES`` histograms, those outside a family's main component with all others,
each pair once however many signatures it shares. Only pairs within the bound leave a block. So a group of near copies
costs a few candidates per member as far as these link, and no link between components is lost.

Disk. Candidates and blocks carry histograms, many times each, so these hold one bit a range: whether its count is odd.
Sets differ at least in as many elements as such bits. Each step's shuffle files and tables go when its result is stored.

Texts are read by streams that keep nothing; sets are built again for the few nodes that have candidates.

Defined results: null and empty texts, or texts without words, have no shingles, link with nothing and are their own
component; with fewer than 5 words the whole sequence is one shingle; rows with equal keys are one node; a null key
gives a null component; an empty table stays empty; extra columns are left out (``one_per_group`` keeps all).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.staging import settled
from .components import components
from .frames import free, map_texts, staged

WORDS = 5
COMMON = 400_000         # shingles on the list of common ones
COMMON_TIMES = 2         # documents of some block
COMMON_AT_ONCE = 1_000   # of one block
BLOCK = 400
LEAST_PARTS = 64
GROUP = 32               # nodes of one signature whose pairs are joined
BLOCK_NODES = 4096
MOST_BITS = 17           # of a histogram: 2^17 ranges
BROADCAST_ROWS = 500_000
KNOWN_WORDS = 50_000

_MULTIPLIERS = [np.uint64(m) for m in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
)]
_words: dict[bytes, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """The ascending hashes of a text's distinct shingles. Only A-Z are lower-cased, only six white spaces part words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > KNOWN_WORDS:
        _words.clear()
    for w in set(words).difference(_words):
        _words[w] = xxhash.xxh3_64_intdigest(w)
    hashed = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - WORDS + 1, 1)
    total = np.full(n, min(len(words), WORDS), np.uint64)
    for k in range(min(WORDS, len(words))):
        total += mixed(hashed[k:k + n]) * _MULTIPLIERS[k]
    return np.unique(mixed(total))


def histogram(shingled: np.ndarray) -> np.ndarray:
    """For each of 1.25 to 2.5 times as many ranges (a power of two), whether an odd number of shingles falls into it:
    packed bits."""
    bits = min(MOST_BITS, max(6, (len(shingled) + len(shingled) // 4).bit_length()))
    counts = np.bincount((shingled >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.packbits((counts & 1).astype(np.uint8))


def may_link(one: bytes, other: bytes, sizes: tuple[int, int]) -> bool:
    """Whether two histograms leave a similarity of 0.75 possible: sets that link differ in a seventh of the sizes' sum."""
    if 4 * min(sizes) < 3 * max(sizes):
        return False
    a, b = (np.frombuffer(h, np.uint8) for h in (one, other))
    size = min(len(a), len(b))
    return 7 * int(np.bitwise_count((_coarser(a, size) ^ _coarser(b, size)).view(np.uint64)).sum()) <= sum(sizes)


def _coarser(odd: np.ndarray, size: int) -> np.ndarray:
    """Histograms (along the last axis) of fewer ranges, in ``size`` bytes."""
    if odd.shape[-1] == size:
        return odd
    bits = np.unpackbits(odd, axis=-1).reshape(*odd.shape[:-1], 8 * size, -1)
    return np.packbits(np.bitwise_xor.reduce(bits, axis=-1), axis=-1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def bands(size: int) -> list[int]:
    """A set's own band (its sizes lie in [2^band, 2^(band + 1))) and the next where a partner may lie."""
    own = size.bit_length() - 1
    return [own, own + 1] if 4 * size >= 3 << own + 1 else [own]


def parts_of(band: int) -> int:
    return max(LEAST_PARTS, ((2 << band) - 1) // 3 + 1, 3 << band >> 2)


def signatures(shingled: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The signatures of one set in all its bands. ``common`` is ascending."""
    n, out = len(shingled), []
    if not n:
        return np.empty(0, np.uint64)
    amounts = mixed(shingled * _MULTIPLIERS[0])
    rare = np.ones(n)
    if len(common):
        rare = (common[np.minimum(np.searchsorted(common, shingled), len(common) - 1)] != shingled).astype(float)
    for band in bands(n):
        parts = parts_of(band)
        part = ((amounts >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(amounts[order], dtype=np.uint64)])
        counts = np.bincount(part, minlength=parts)
        ends = np.cumsum(counts)
        content = sums[ends] - sums[ends - counts]
        place = np.arange(parts, dtype=np.uint64) * _MULTIPLIERS[1] + np.full(parts, band, np.uint64) * _MULTIPLIERS[2]
        sig = mixed(mixed(content) + place)
        first = np.lexsort((sig, -counts, -np.bincount(part, weights=rare, minlength=parts)))[:n // 3 + 1]
        out.append(sig[first])
    return np.concatenate(out)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    texts = batch.column("text")
    for at in range(0, batch.num_rows, BLOCK):
        yield at, [shingles(t.as_py()) for t in texts.slice(at, BLOCK)]


def _measured(docs: DataFrame, kind: str) -> DataFrame:
    """Per row: set size, a 128-bit digest of the set, its histogram; on each block's first row its common shingles."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _rows(batch):
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                often = np.flatnonzero(counts >= COMMON_TIMES)
                often = often[np.argsort(-counts[often], kind="stable")[:COMMON_AT_ONCE]]
                digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                low = np.array([d & (1 << 64) - 1 for d in digests], np.uint64).view(np.int64)
                high = np.array([d >> 64 for d in digests], np.uint64).view(np.int64)
                rest = [[]] * (len(sets) - 1)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(at, BLOCK), "n": pa.array(map(len, sets), pa.int64()),
                    "d1": pa.array(low), "d2": pa.array(high),
                    "hist": pa.array([histogram(s).tobytes() for s in sets], pa.binary()),
                    "common": pa.array([values[often].view(np.int64), *rest], pa.list_(pa.int64())),
                    "times": pa.array([counts[often], *rest], pa.list_(pa.int64())),
                })

    schema = f"doc_id {kind}, n bigint, d1 bigint, d2 bigint, hist binary, common array<bigint>, times array<bigint>"
    return map_texts(docs, schema, work)


def _common(measured: DataFrame) -> np.ndarray:
    """The most common shingles, ascending: a list of bounded length."""
    counted = measured.where(F.size("common") > 0).select(F.explode(F.arrays_zip("common", "times")).alias("c"))
    sums = counted.groupBy("c.common").agg(F.sum("c.times").alias("times"))
    top = sums.orderBy(F.desc("times"), "common").limit(COMMON).select("common").toArrow()
    return np.sort(top["common"].to_numpy().astype(np.int64).view(np.uint64))


def _small(df: DataFrame) -> DataFrame:
    """A hint to broadcast a one-column table of proven size."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _signed(docs: DataFrame, kind: str, common: np.ndarray) -> DataFrame:
    """``sig, node``: one row per signature."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _rows(batch):
                sigs = [signatures(s, shared.value) for s in sets]
                owner = np.repeat(np.arange(at, at + len(sets)), [len(s) for s in sigs])
                yield pa.record_batch({
                    "sig": pa.array(np.concatenate(sigs).view(np.int64)),
                    "node": batch.column("doc_id").take(pa.array(owner)),
                })

    return map_texts(docs, f"sig bigint, node {kind}", work)


def _sides(pairs: DataFrame, values: DataFrame, *names: str) -> DataFrame:
    """``pairs(a, b)`` with the named columns of both ends."""
    for side in ("a", "b"):
        own = values.select(F.col("doc_id").alias(side), *[F.col(n).alias(f"{n}_{side}") for n in names])
        pairs = pairs.join(own, side)
    return pairs


def _possible(pairs: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """Those of ``pairs(a, b)`` that may link by the histograms of ``nodes``."""
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("hist_a", "hist_b", "n_a", "n_b")]
            kept = [may_link(x, y, (m, n)) for x, y, m, n in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return _sides(pairs, nodes, "n", "hist").mapInArrow(bound, f"a {kind}, b {kind}")


def _verified(docs: DataFrame, possible: DataFrame, kind: str, repeated: bool) -> DataFrame:
    """Those of ``possible(a, b)`` that link by their sets. Staged. ``repeated``: whether keys may occur again."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = lambda c: [np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()]
            kept = [similar(x, y) for x, y in zip(read("set_a"), read("set_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _rows(batch):
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(at, BLOCK),
                    "set": pa.array([s.tobytes() for s in sets], pa.binary()),
                })

    possible = staged(possible, "possible")
    wanted = staged(_both_ends(possible).distinct(), "wanted")
    chosen = docs.join(_small(wanted), "doc_id", "left_semi")
    built = chosen.mapInArrow(build, f"doc_id {kind}, set binary")
    sets = staged(built.distinct() if repeated else built, "sets")
    return staged(_sides(possible, sets, "set").mapInArrow(exact, f"a {kind}, b {kind}").distinct(), "verified")


def _block_pairs(first: pa.Table, second: pa.Table, same: bool) -> pa.Table:
    """The pairs of nodes of two blocks (or of one, if they are the same) in different components that may link."""
    def columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        labels = table["component"].to_numpy(zero_copy_only=False)
        hists = [np.frombuffer(h, np.uint8) for h in table["hist"].to_pylist()]
        return labels, table["n"].to_numpy(), hists

    (label, n, hist), (other_label, other_n, other_hist) = columns(first), columns(second)
    lengths = sorted({len(h) for h in other_hist})
    groups = {size: np.flatnonzero([len(h) == size for h in other_hist]) for size in lengths}
    stacks = {size: np.stack([other_hist[j] for j in groups[size]]) for size in lengths}
    folded = {(size, least): _coarser(stack, least).view(np.uint64)
              for size, stack in stacks.items() for least in {min(size, len(h)) for h in hist}}
    left, right = [], []
    for i, own in enumerate(hist):
        for size, members in groups.items():
            least = min(size, len(own))
            total = n[i] + other_n[members]
            differing = np.bitwise_count(folded[size, least] ^ _coarser(own, least).view(np.uint64)).sum(1, dtype=np.int64)
            near = 7 * differing <= total
            near &= 4 * np.minimum(n[i], other_n[members]) >= 3 * np.maximum(n[i], other_n[members])
            near &= other_label[members] != label[i]
            if same:
                near &= members > i
            found = members[near]
            left += [i] * len(found)
            right += found.tolist()
    x, y = first["node"].take(pa.array(left, pa.int64())), second["node"].take(pa.array(right, pa.int64()))
    return pa.table({"a": pc.if_else(pc.less(x, y), x, y), "b": pc.if_else(pc.less(x, y), y, x)})


def _family_pairs(large: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """The pairs between components that large signature groups leave, within the bound, each once.

    ``large(sig, node, component)``. Groups that overlap form a family. Its nodes are dealt into blocks: those of the
    component that most of them are in (they need not meet one another) and the rest.
    """
    least = large.groupBy("sig").agg(F.min("node").alias("least"))
    star = large.join(least, "sig").select(F.col("node").alias("a"), F.col("least").alias("b"))
    family = components(star).withColumnRenamed("component", "family")
    info = staged(large.select("node", "component").distinct().join(family, "node"), "families")
    each = info.groupBy("family", "component").agg(F.count(F.lit(1)).alias("size"))
    main = each.groupBy("family").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"),
        F.max("size").alias("inside"), F.sum("size").alias("total"),
    )
    blocks = lambda size: F.ceil(size / F.lit(BLOCK_NODES)).cast("int")
    dealt = info.join(main, "family").select(
        "family", "node", "component", (F.col("component") == F.col("main")).alias("inside"),
        blocks(F.col("inside")).alias("mains"), blocks(F.col("total") - F.col("inside")).alias("rests"),
    ).where("rests > 0").join(nodes.select(F.col("doc_id").alias("node"), "n", "hist"), "node")
    number = F.xxhash64("node")
    own = F.pmod(number, F.when(F.col("inside"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    meet = lambda is_main, x, y, side: F.struct(
        F.lit(is_main).alias("with_main"), x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(side).alias("side")
    )
    upto = lambda count, make: F.transform(F.sequence(F.lit(0), F.col(count) - 1), make)
    # Side 0 is the block x, side 1 the block y; a block that meets itself is there once.
    outside = F.concat(
        upto("rests", lambda i: F.when(i < F.col("own"), meet(False, i, F.col("own"), 1)).otherwise(meet(False, F.col("own"), i, 0))),
        upto("mains", lambda j: meet(True, F.col("own"), j, 0)),
    )
    meetings = dealt.withColumn("own", own).select(
        "family", "node", "component", "n", "hist",
        F.explode(F.when(F.col("inside"), upto("rests", lambda i: meet(True, i, F.col("own"), 1))).otherwise(outside)).alias("at"),
    ).select("family", "node", "component", "n", "hist", "at.*")

    def compare(table: pa.Table) -> pa.Table:
        sides = [table.filter(pc.equal(table["side"], side)) for side in (0, 1)]
        same = not table["with_main"][0].as_py() and table["x"][0] == table["y"][0]
        return _block_pairs(sides[0], sides[0] if same else sides[1], same)

    return meetings.groupBy("family", "with_main", "x", "y").applyInArrow(compare, f"a {kind}, b {kind}").distinct()


def _both_ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))


def groups(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    kind, spark = docs.schema[key].dataType.simpleString(), docs.sparkSession
    docs = docs.select(F.col(key).alias("doc_id"), "text")
    every = staged(_measured(docs, kind), "measured")
    measured = every.select("doc_id", "n", "d1", "d2")
    full = measured.where("n > 0 and doc_id is not null")

    # One node per distinct set: its least key. Keys that hold several sets tie their nodes together.
    classes = staged(full.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last")), "classes")
    member = full.select("doc_id", "d1", "d2").distinct().join(classes, ["d1", "d2"])
    owned = member.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("other"), F.count(F.lit(1)).alias("sets"))
    copies = staged(owned.where("sets = 1 and doc_id <> node").select("doc_id"), "copies")
    ties = member.join(owned.where("sets > 1").select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")
    )

    repeated = not full.groupBy("doc_id").count().where("count > 1").isEmpty()
    nodes = docs.where(F.col("doc_id").isNotNull()).join(_small(copies), "doc_id", "left_anti")
    shared = Window.partitionBy("sig")
    ordered = shared.orderBy("node")
    signed = _signed(nodes, kind, _common(every))
    together = settled(spark, lambda: signed.withColumns({
        "least": F.min("node").over(shared), "most": F.max("node").over(shared), "before": F.lag("node").over(ordered),
    }).where("least < most and (before is null or before < node)"), "together")
    pick = lambda c: together.select(F.col(c).alias("a"), F.col("node").alias("b")).where("a < b")
    tried = settled(spark, lambda: pick("least").unionByName(pick("before")).distinct(), "tried")
    known = every.select("doc_id", "n", "hist").where("n > 0 and doc_id is not null")
    known = known.distinct() if repeated else known
    verified = lambda pairs: settled(spark, lambda: _verified(docs, pairs, kind, repeated), "verified")
    first = verified(_possible(tried, known, kind)).unionByName(ties)

    # Signatures whose nodes are in different components still: every pair between components.
    found = settled(spark, lambda: components(first), "components")
    member = together.select("sig", "node").join(_small(found), "node", "left").select(
        "sig", "node", F.coalesce("component", "node").alias("component")
    )
    apart = member.groupBy("sig").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("nodes")
    ).where("x < y").select("sig", "nodes")
    open_ = settled(spark, lambda: member.join(_small(staged(apart, "apart")), "sig"), "open")
    few = open_.where(F.col("nodes") <= GROUP)
    left = few.select("sig", F.col("node").alias("a"), F.col("component").alias("x"))
    right = few.select("sig", F.col("node").alias("b"), F.col("component").alias("y"))
    pairs = left.join(right, "sig").where("a < b and x <> y").select("a", "b").distinct()
    rest = settled(spark, lambda: _possible(pairs.join(tried, ["a", "b"], "left_anti"), known, kind), "rest")
    many = settled(spark, lambda: _family_pairs(open_.where(F.col("nodes") > GROUP), known, kind), "many")
    second = verified(rest.unionByName(many.join(tried, ["a", "b"], "left_anti")).distinct())

    final = settled(spark, lambda: components(first.unionByName(second)), "components")
    placed = measured.join(classes.select("d1", "d2", "node"), ["d1", "d2"], "left").join(final, "node", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id")
    )


def one_per_group(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those that link to a row with a smaller key, however far."""
    gone = free("gone")
    later = lambda: groups(docs, key).where("component_id < doc_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(_small(settled(docs.sparkSession, later, "later")), F.col(f"`{key}`") == F.col(gone), "left_anti")
