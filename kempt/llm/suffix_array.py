"""The suffix array of many strings, by a distributed difference-cover algorithm.

A string is a row: its number and its symbols (whole numbers whose order counts). One level:

* the suffixes at places 1 and 2 modulo 3 are the sample; their first three symbols, a triple, are sorted over the cluster by
  range partitions, and the number of samples with a smaller triple is the triple's name;
* if triples repeat, each string gives two shorter ones, the names at places 1, 4, 7... and those at 2, 5, 8...; their
  suffix array is found the same way and ranks the sample;
* the other suffixes, at places 0 modulo 3, are merged in: against places 1 modulo 3 by one symbol and the rank of
  the next suffix, against places 2 modulo 3 by two symbols and the rank of the one after. Two sorts count
  for each suffix how many of the other kind are smaller.

Symbols have spans, and only prefixes of ``depth`` count: triples that repeat but span as much need no longer ones. Suffixes
that agree so far may come in any order, and share numbers; all others are in their order. Where few triples
are still unclear, only the stretches of them go down a level, each with the clear one behind it: all places of an
unclear triple are in them, so their order among themselves, added to the triple's name, is their rank.

Since only ``depth`` counts, an unclear suffix can also be told by the symbols that span as much. Where these are a few per
symbol of the level (``KEY_SYMBOLS``), one sort of them takes the place of all further levels. Text that is cut every few
bytes has long keys, and goes down.

Each level is groupings, joins and range sorts over rows of a few numbers, cut from its lineage in the shared
checkpoint folder; level k has (2/3)^k of the symbols, so all together cost about three times the first. Equal
triples are counted with partial sums and joined back by plain inner joins, which the engine splits where one is hot.
Sums over sorted rows run inside tasks; one total per task passes through the driver. A task's rows of one
string are bounded by that string.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import settled
from .frames import staged

STRING = "s bigint, names array<bigint>, spans array<int>"
KEY_SYMBOLS = 4         # in all keys together, per symbol of a level


def totals_before(df: DataFrame, order: Sequence[str], sums: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and, for each column of ``sums``, ``before_<column>``: its total over the rows that sort before."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    every = list(dict.fromkeys([*keep, *sums]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, part = dict.fromkeys(sums, 0), TaskContext.get().partitionId()
        for batch in batches:
            out = {c: batch.column(batch.schema.get_field_index(c)) for c in every}
            for c in sums:
                values = out[c].to_numpy(zero_copy_only=False).astype(np.int64)
                after = np.cumsum(values) + carry[c]
                out[f"before_{c}"] = pa.array(after - values)
                carry[c] = int(after[-1]) if len(after) else carry[c]
            yield pa.record_batch({**out, "part": pa.array(np.full(batch.num_rows, part, np.int32))})

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in every), *(f"before_{c} bigint" for c in sums), "part int"])
    # Ascending partitions of ascending rows; the part is stored with the rows, so a retried task cannot change it.
    ordered = df.select(*dict.fromkeys([*order, *every])).repartitionByRange(*order).sortWithinPartitions(*order)
    done = staged(ordered.mapInArrow(work, schema), "ordered")
    parts = done.groupBy("part").agg(*[F.sum(c).cast("bigint").alias(c) for c in sums]).orderBy("part").collect()
    offsets, total = [], dict.fromkeys(sums, 0)
    for p in parts:
        offsets.append((p["part"], *total.values()))
        total = {c: total[c] + p[c] for c in sums}
    small = df.sparkSession.createDataFrame(offsets, "part int, " + ", ".join(f"from_{c} bigint" for c in sums))
    joined = done.join(F.broadcast(small), "part")
    return joined.select(*keep, *[(F.col(f"before_{c}") + F.col(f"from_{c}")).alias(f"before_{c}") for c in sums])


def by_string(rows: DataFrame, schema: str, work: Callable[[pa.Table], pa.RecordBatch]) -> DataFrame:
    """``work`` over the rows ``s, i ...`` of whole strings, in their order.

    The rows are sorted as they are, since lists that the engine's groupings collect are copied item by item.
    """
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            s = batch.column(0).to_numpy()
            last = int(np.searchsorted(s, s[-1]))
            # A batch of one string leaves open where that ends.
            if last or (held and held[-1].column(0)[0].as_py() != s[0]):
                done = [*held, *([batch.slice(0, last)] if last else [])]
                yield work(pa.Table.from_batches(done).combine_chunks())
                held = []
            held.append(batch.slice(last))
        if held:
            yield work(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition("s").sortWithinPartitions("s", "i").mapInArrow(whole, schema)


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows of one or more differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def gathered(symbols: DataFrame, *others: str) -> DataFrame:
    """Strings from rows ``s, i, name, span``; other columns become lists under their own names."""
    kinds = {f.name: f.dataType.simpleString() for f in symbols.schema.fields}

    def work(table: pa.Table) -> pa.RecordBatch:
        s = table.column("s").to_numpy()
        first = _begins(s)
        offsets = pa.array(np.append(first, len(s)).astype(np.int32))
        listed = lambda c: pa.ListArray.from_arrays(offsets, table.column(c).chunk(0))
        return pa.record_batch({
            "s": s[first], "names": listed("name"), "spans": listed("span"), **{c: listed(c) for c in others},
        })

    rows = symbols.select("s", "i", "name", F.col("span").cast("int").alias("span"), *others)
    return by_string(rows, ", ".join([STRING, *(f"{c} array<{kinds[c]}>" for c in others)]), work)


class Level:
    """The strings of one batch side by side: flat symbols, each with its place and its string's size."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        at = lambda name: batch.column(batch.schema.get_field_index(name))
        self.sizes = np.diff(at("names").offsets.to_numpy()).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.s = at("s").to_numpy()[self.row]
        self.i = np.arange(len(self.row)) - self.starts[self.row]
        self.names = at("names").flatten().to_numpy(zero_copy_only=False)
        self.batch = batch

    def flat(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a list column, and where each row's begin. A missing list is empty."""
        column = self.batch.column(self.batch.schema.get_field_index(name))
        sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
        return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes

    def later(self, values: np.ndarray, step: int, shift: int) -> np.ndarray:
        """The value ``step`` places on, plus ``shift``; 0 beyond the string's end."""
        out = np.zeros(len(self.i), np.int64)
        inside = np.flatnonzero(self.i + step < self.sizes[self.row])
        out[inside] = values[inside + step] + shift
        return out


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        level = Level(batch)
        spans = level.flat("spans")[0].astype(np.int64)
        span = spans + level.later(spans, 1, 0) + level.later(spans, 2, 0)
        sample = level.i % 3 > 0
        yield pa.record_batch({
            "s": level.s[sample], "i": level.i[sample], "a": level.names[sample] + 1,
            "b": level.later(level.names, 1, 1)[sample], "c": level.later(level.names, 2, 1)[sample],
            "span": np.minimum(span, 1 << 30).astype(np.int32)[sample],
        })


def _merging(other: int):
    """Rows that order the suffixes at places 0 and ``other`` modulo 3 among each other."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level = Level(batch)
            ranks = np.zeros(len(level.i), np.int64)
            for kind in (1, 2):
                values, starts = level.flat(f"ranks{kind}")
                here = level.i % 3 == kind
                ranks[here] = values[starts[level.row[here]] + level.i[here] // 3]
            chosen = (level.i % 3 == 0) | (level.i % 3 == other)
            second = level.later(level.names, 1, 1) if other == 2 else np.zeros(len(level.i), np.int64)
            zero = (level.i % 3 == 0).astype(np.int32)
            yield pa.record_batch({
                "s": level.s[chosen], "i": level.i[chosen], "a": level.names[chosen] + 1, "b": second[chosen],
                "c": level.later(ranks, other, 1)[chosen], "own": ranks[chosen], "zero": zero[chosen], "sample": 1 - zero[chosen],
            })
    return work


def _summed(table: pa.Table) -> pa.RecordBatch:
    """Ranks by place from rows ``s, i, value``; every place has one, or two that add up."""
    s, i, value = (table.column(c).to_numpy() for c in ("s", "i", "value"))
    places = _begins(s, i)
    ranks, s = np.add.reduceat(value, places), s[places]
    first = _begins(s)
    offsets = pa.array(np.append(first, len(s)).astype(np.int32))
    return pa.record_batch({"s": s[first], "ranks": pa.ListArray.from_arrays(offsets, pa.array(ranks))})


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``s, start, names, spans, unclear``: stretches of unclear symbols, each with the clear one behind it."""
    for batch in batches:
        level = Level(batch)
        unclear = level.flat("unclear")[0].astype(bool)
        before = np.append(False, unclear[:-1]) & (level.i > 0)
        kept = np.flatnonzero(unclear | before)
        if not len(kept):
            continue
        # A stretch begins at an unclear symbol with no unclear one before it in its string.
        first = np.flatnonzero((unclear & ~before)[kept])
        offsets = pa.array(np.append(first, len(kept)).astype(np.int32))
        listed = lambda values, kind: pa.ListArray.from_arrays(offsets, pa.array(values[kept], kind))
        yield pa.record_batch({
            "s": level.s[kept][first], "start": level.i[kept][first], "names": listed(level.names, pa.int64()),
            "spans": listed(level.flat("spans")[0], pa.int32()), "unclear": listed(unclear, pa.bool_()),
        })


def _unclear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``s, i, name, rank`` of the unclear places of ranked stretches."""
    for batch in batches:
        level = Level(batch)
        chosen = level.flat("unclear")[0].astype(bool)
        start = batch.column(batch.schema.get_field_index("start")).to_numpy()[level.row]
        yield pa.record_batch({
            "s": level.s[chosen], "i": (level.i + start)[chosen], "name": level.names[chosen],
            "rank": level.flat("ranks")[0][chosen],
        })


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names plus what ``items`` (place, value) add to some of them."""
    for batch in batches:
        level = Level(batch)
        items = batch.column(batch.schema.get_field_index("items"))
        sizes = np.diff(items.offsets.to_numpy()).astype(np.int64)
        places, values = (items.flatten().field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        ranks = level.names.astype(np.int64)
        ranks[np.repeat(level.starts, sizes) + places] += values
        offsets = pa.array(np.append(level.starts, len(ranks)).astype(np.int32))
        yield pa.record_batch({
            "s": batch.column(0), "ranks": pa.ListArray.from_arrays(offsets, pa.array(ranks)),
        })


def _key_ends(level: Level, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The unclear places, and where the symbols that span ``depth`` from each on end, in its string."""
    before = np.append(0, np.cumsum(level.flat("spans")[0], dtype=np.int64))
    places = np.flatnonzero(level.flat("unclear")[0])
    row = level.row[places]
    return places, np.minimum(np.searchsorted(before, before[places] + depth), (level.starts + level.sizes)[row])


def _key_sizes(depth: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level = Level(batch)
            places, ends = _key_ends(level, depth)
            yield pa.record_batch({
                "every": pa.array([len(level.i)], pa.int64()), "below": pa.array([len(places)], pa.int64()),
                "keyed": pa.array([int((ends - places).sum())], pa.int64()),
            })
    return work


def _keys(depth: int):
    """``s, i, name, key`` of the unclear places; keys, as bytes, are in the order of the symbols that they hold."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level = Level(batch)
            places, ends = _key_ends(level, depth)
            data = level.names.astype(">i8").tobytes()
            keys = [data[8 * a:8 * b] for a, b in zip(places.tolist(), ends.tolist(), strict=True)]
            yield pa.record_batch({
                "s": level.s[places], "i": level.i[places], "name": level.names[places], "key": pa.array(keys, pa.binary()),
            })
    return work


def _by_keys(strings: DataFrame, depth: int) -> DataFrame:
    """``s, i, value`` of the unclear places: how many of the same name are smaller, where any is."""
    rows = staged(strings.mapInArrow(_keys(depth), "s bigint, i bigint, name bigint, key binary"), "keys")
    distinct = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("name").alias("name"))
    ordered = totals_before(distinct, ["key"], ["n"], ["key", "name"])
    base = staged(ordered.groupBy("name").agg(F.min("before_n").alias("base")), "base")
    # Written, so that both sides of the join are dealt for it alone and the engine can split a hot key.
    values = staged(ordered.join(base, "name").select("key", (F.col("before_n") - F.col("base")).alias("value")).where("value > 0"), "values")
    return rows.select("s", "i", "key").join(values, "key").select("s", "i", "value")


def _refined(strings: DataFrame, depth: int) -> DataFrame:
    """``s, ranks`` of strings ``s, names, spans, unclear`` of the sample, whose names may stand for several suffixes."""
    counted = strings.mapInArrow(_key_sizes(depth), "every bigint, below bigint, keyed bigint")
    every, below, keyed = (n or 0 for n in counted.agg(F.sum("every"), F.sum("below"), F.sum("keyed")).first())
    if not below:
        return strings.select("s", F.col("names").alias("ranks"))
    if keyed <= KEY_SYMBOLS * every:
        return _with(strings, _by_keys(strings, depth))
    if 3 * below > every:
        return suffix_ranks(strings.drop("unclear"), depth)
    kind = "s bigint, start bigint, names array<bigint>, spans array<int>, unclear array<boolean>"
    stretches = staged(strings.mapInArrow(_stretches, kind).withColumn("t", F.monotonically_increasing_id()), "stretches")
    ranks = suffix_ranks(stretches.select(F.col("t").alias("s"), "names", "spans"), depth).withColumnRenamed("s", "t")
    placed = stretches.select("t", "s", "start", "names", "unclear").join(ranks, "t").drop("t")
    rows = staged(placed.mapInArrow(_unclear, "s bigint, i bigint, name bigint, rank bigint"), "unclear")
    # The least rank of an unclear triple's places comes off, so that they count among themselves.
    base = staged(rows.groupBy("name").agg(F.min("rank").alias("base")), "base")
    return _with(strings, rows.join(base, "name").select("s", "i", (F.col("rank") - F.col("base")).alias("value")))


def _with(strings: DataFrame, values: DataFrame) -> DataFrame:
    """``s, ranks``: the names of ``strings`` plus the values ``s, i, value`` of some places."""
    items = values.groupBy("s").agg(F.collect_list(F.struct("i", "value")).alias("items"))
    none = F.array().cast("array<struct<i:bigint,value:bigint>>")
    both = strings.select("s", "names").join(items, "s", "left").withColumn("items", F.coalesce("items", none))
    return both.mapInArrow(_added, "s bigint, ranks array<bigint>")


def suffix_ranks(strings: DataFrame, depth: int) -> DataFrame:
    """``s, ranks``: for each place of each string ``s, names, spans`` the number of smaller suffixes among all.

    ``strings`` should be a written table, since it is read several times.
    """
    return settled(strings.sparkSession, lambda: _suffix_ranks(strings, depth), "ranks")


def _suffix_ranks(strings: DataFrame, depth: int) -> DataFrame:
    def sampled() -> DataFrame:
        triples = strings.mapInArrow(_triples, "s bigint, i bigint, a bigint, b bigint, c bigint, span int")
        distinct = triples.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"), F.first("span").alias("span"))
        # Written, so that both sides of the join are dealt for it alone and the engine can split a hot triple.
        named = staged(totals_before(distinct, ["a", "b", "c"], ["n"], ["a", "b", "c", "n", "span"]), "triples").select(
            "a", "b", "c", "span", F.col("before_n").alias("name"), ((F.col("n") > 1) & (F.col("span") < depth)).alias("unclear")
        )
        samples = triples.drop("span").join(named, ["a", "b", "c"])
        return gathered(samples.select(
            (F.col("s") * 2 + F.col("i") % 3 - 1).alias("s"), F.expr("i div 3").alias("i"), "name", "span", "unclear"
        ), "unclear")

    spark = strings.sparkSession
    shorter = settled(spark, sampled, "strings")
    ranks = _refined(shorter, depth)
    kind = lambda k: ranks.where(F.col("s") % 2 == k - 1).select(F.expr("s div 2").alias("s"), F.col("ranks").alias(f"ranks{k}"))
    empty = F.array().cast("array<bigint>")
    level = staged(strings.select("s", "names").join(kind(1), "s", "left").join(kind(2), "s", "left").select(
        "s", "names", *[F.coalesce(f"ranks{k}", empty).alias(f"ranks{k}") for k in (1, 2)]
    ), "level")
    rows = "s bigint, i bigint, a bigint, b bigint, c bigint, own bigint, zero int, sample int"
    values = []
    for other in (1, 2):
        # String and place after the rest, so that suffixes which agree too far to be told apart spread over tasks.
        counted = totals_before(
            level.mapInArrow(_merging(other), rows), ["a", "b", "c", "s", "i"], ["zero", "sample"], ["s", "i", "own", "zero"]
        )
        # A suffix at place 0 has all smaller ones of either kind before it; the zeros are counted once.
        own = F.col("before_sample") + (F.col("before_zero") if other == 1 else F.lit(0))
        values.append(counted.select("s", "i", F.when(F.col("zero") == 1, own).otherwise(
            F.col("own") + F.col("before_zero")
        ).alias("value")))
    return by_string(values[0].unionByName(values[1]), "s bigint, ranks array<bigint>", _summed)
