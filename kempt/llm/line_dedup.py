"""Line dedup: later copies of line runs that repeat across a corpus are deleted.

A run is a sequence of whole lines of one document with at least ``min_words`` words. If an equal run stands earlier (a
smaller document key, or further up in the same document), its lines are deleted here; the first copy stays. The result
is the union of all such maximal runs.

Method: a suffix array over line numbers by prefix doubling. Level 0 ranks lines that occur twice or more; level
j + 1 ranks positions by the pair (rank of the first 2^j lines, rank of the next 2^j), sorted over the cluster by range
partitions, so that ranks follow the order of the suffixes. A position whose 2^j lines occur once leaves: only
repeated text goes on. Suffixes that agree in their first n lines are one interval of the array with a longest common
prefix of n or more; two overlapping ranks name the interval of any n. A maximal repeated run is covered by its
shortest windows that reach ``min_words``: those that start at a line and those that end at one. So each window's
interval is looked up, its first member kept, and the windows of all other members are deleted. Doubling ends at the
longest window: 1 level for lines of 50 words, more for short ones.

All of it is joins, groupings and windows of the engine. Rows between the steps are a few numbers per repeated line;
tables are cut from their lineage in the shared checkpoint folder. A hot line or passage is counted with partial sums;
joins on its rank are plain inner joins, which the engine splits where one key is hot. Only windows over one
document gather rows of a document.

Defined results: a null text stays null, has no lines and deletes nothing; blank lines are lines of no words; rows
equal in key and text are one document and get equal results; rows with a null key stay as they are; a document whose
lines are all deleted keeps its row with an empty text; an empty table stays empty; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import free, staged

MIN_WORDS = 50
DOC = ["doc", "copy"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _word_count(line: Column) -> Column:
    return F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def _numbered_lines(docs: DataFrame, key: str) -> DataFrame:
    """``doc, copy, pos, h1, h2, words``: one row per line; two 64-bit hashes stand for its text."""
    lines = docs.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64("text").alias("copy"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    )
    return lines.select(
        *DOC, "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"),
        _word_count(F.col("line")).alias("words"),
    )


def _ranks(rows: DataFrame, by: list[str]) -> DataFrame:
    """``first, second, place``: the values of two columns that occur twice or more, with ranks in their order.

    Sorted tables have ascending partitions, so a row's partition and place in it make an ascending rank.
    """
    repeated = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by)
    pairs = repeated.toDF("first", "second").orderBy("first", "second")
    return staged(pairs.withColumn("place", F.monotonically_increasing_id()), "ranks")


def _windows(active: DataFrame, min_words: int) -> DataFrame:
    """``doc, copy, pos, size``: the shortest windows of repeated lines with ``min_words`` words, by start and by end."""
    order = Window.partitionBy(*DOC).orderBy("pos")
    # Lines in a row without a gap form an island; windows never leave it.
    island = active.withColumn("island", F.col("pos") - F.row_number().over(order))
    inside = Window.partitionBy(*DOC, "island").orderBy("pos")
    before = F.coalesce(F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.lead("pos").over(inside).isNull()
    # One more row behind the last line, so that every window has an end.
    edge = lambda pos, words: F.struct(pos.cast("int").alias("pos"), words.cast("bigint").alias("before"))
    own = edge(F.col("pos"), F.col("before"))
    behind = edge(F.col("pos") + 1, F.col("before") + F.col("words"))
    edges = island.select(*DOC, "island", "pos", "words", before.alias("before"), last.alias("last")).select(
        *DOC, "island", F.explode(F.when(F.col("last"), F.array(own, behind)).otherwise(F.array(own))).alias("edge")
    ).select(*DOC, "island", F.col("edge.pos").alias("pos"), F.col("edge.before").alias("before"))
    by_words = Window.partitionBy(*DOC, "island").orderBy("before")
    end = F.min("pos").over(by_words.rangeBetween(min_words, Window.unboundedFollowing))
    start = F.max("pos").over(by_words.rangeBetween(Window.unboundedPreceding, -min_words))
    found = edges.select(*DOC, "pos", start.alias("start"), end.alias("end"))
    pairs = F.array(
        F.struct(F.col("pos").alias("pos"), (F.col("end") - F.col("pos")).alias("size")),
        F.struct(F.col("start").alias("pos"), (F.col("pos") - F.col("start")).alias("size")),
    )
    return found.select(*DOC, F.explode(pairs).alias("w")).select(*DOC, "w.pos", "w.size").where(
        F.col("pos").isNotNull() & F.col("size").isNotNull()
    ).distinct()


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id") -> DataFrame:
    """``doc, copy, runs``: per document with later copies, their line ranges (first, end), apart and ascending."""
    lines = staged(_numbered_lines(docs, key), "lines")
    active = staged(
        lines.join(_ranks(lines, ["h1", "h2"]), (F.col("h1") == F.col("first")) & (F.col("h2") == F.col("second")))
        .select(*DOC, "pos", "words", F.col("place").alias("rank")).dropDuplicates([*DOC, "pos"]), "level",
    )
    windows = staged(_windows(active, min_words), "windows")
    longest = windows.agg(F.max("size")).first()[0] or 0

    level = active.select(*DOC, "pos", "rank")
    levels, width, number = [level.withColumn("level", F.lit(0))], 1, 0
    while 2 * width <= longest:
        following = level.select(*DOC, (F.col("pos") - width).alias("pos"), F.col("rank").alias("next"))
        pairs = level.join(following, [*DOC, "pos"])
        ranks = _ranks(pairs, ["rank", "next"])
        level = staged(
            pairs.join(ranks, (F.col("rank") == F.col("first")) & (F.col("next") == F.col("second")))
            .select(*DOC, "pos", F.col("place").alias("rank")), "level",
        )
        width, number = 2 * width, number + 1
        levels.append(level.withColumn("level", F.lit(number)))

    every = levels[0]
    for one in levels[1:]:
        every = every.unionByName(one)
    # The interval of a window: its length, and the ranks of the longest doubled stretches at its two ends.
    step = F.floor(F.log2("size") + 1e-9).cast("int")
    sized = windows.withColumn("level", step).withColumn("tail", F.expr("pos + size - shiftleft(1, level)"))
    heads = sized.join(every.withColumnRenamed("rank", "head"), [*DOC, "level", "pos"])
    tails = every.withColumnRenamed("rank", "foot").withColumnRenamed("pos", "tail")
    named = staged(
        heads.join(tails, [*DOC, "level", "tail"]).select(*DOC, "pos", "size", "head", "foot"), "intervals"
    )
    interval = ["size", "head", "foot"]
    place = F.struct(*DOC, "pos")
    firsts = named.groupBy(*interval).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    # Written, so that both sides of the join are dealt for it alone and the engine can split a hot interval.
    firsts = staged(firsts.select(*interval, "first"), "firsts")
    later = named.join(firsts, interval).where(place > F.col("first"))
    spans = later.groupBy(*DOC).agg(
        F.sort_array(F.collect_set(F.struct(F.col("pos").alias("first"), (F.col("pos") + F.col("size")).alias("end")))).alias("spans")
    )
    return spans.select(*DOC, _joined(F.col("spans")).alias("runs"))


def _joined(spans: Column) -> Column:
    """Sorted line ranges with those that touch or overlap made one."""
    one = "array<struct<first:int,end:int>>"

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        touching = (F.size(done) > 0) & (span["first"] <= F.try_element_at(done, F.lit(-1))["end"])
        grown = F.concat(
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
            F.array(F.struct(last["first"].alias("first"), F.greatest(last["end"], span["end"]).alias("end"))),
        ).cast(one)
        return F.when(touching, grown).otherwise(F.concat(done, F.array(span)).cast(one))

    return F.aggregate(spans, F.array().cast(one), add)


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id") -> tuple[DataFrame, str]:
    """``docs`` with the later copies taken out of ``text``, and a column (its name comes second) of the deleted ranges.

    The ranges are null where nothing was deleted.
    """
    doc, copy, runs = free("doc"), free("copy"), free("runs")
    found = repeated_runs(docs, min_words, key).toDF(doc, copy, runs)
    joined = docs.withColumn(copy, F.xxhash64("text")).join(
        found.withColumnRenamed(copy, copy + "_"),
        (F.col(f"`{key}`") == F.col(doc)) & (F.col(copy) == F.col(copy + "_")), "left",
    )
    kept = F.filter(_lines(F.col("text")), lambda line, i: ~F.exists(
        F.col(runs), lambda r: (i >= r["first"]) & (i < r["end"])
    ))
    text = F.when(F.col(runs).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns], runs), runs
