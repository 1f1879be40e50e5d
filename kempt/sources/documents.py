"""JSON documents of any size: the records of a file that is one document, as lines.

A file is read in pieces that end at a closing brace, so it stays split over many tasks. What a piece does to the state
of the text before it (inside or outside a string, and how many brackets are open) depends on that state only by
whether it is inside a string; so pieces are summed up for both cases, first inside each block of a file, then over its
blocks. Then every piece knows where it stands, and so where records begin and end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.staging import collecting, new_path, release, settled, staged

# A string, or the begin of one that the piece does not end. Possessive, so that long texts need no stack.
STRINGS = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?\z)'
# A string with a line end in it is no JSON.
PROPER = r'(?s)"[^"\\\r\n]*+(?:\\.[^"\\\r\n]*+)*+"'
ARRAY = r"\A\s*\[(?=\s*\{)"
DATA = r'"data"\s*:\s*\[(?=\s*\{)'

# The longest text around the records of one document, which one task checks as a whole.
AROUND = 16 << 20


def _outside(text: Column) -> Column:
    """Whether a text that begins outside a string ends outside one."""
    plain = F.when(text.contains("\\"), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)
    return (F.length(plain) - F.length(F.translate(plain, '"', ""))) % 2 == 0


def sole_document(text: Column) -> Column:
    """The variant ``[document, 7]`` of a text that is exactly one JSON document, else null."""
    # The parser ignores what follows a document; inside a list, a closing bracket too many shows by the number after it.
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(",7]")))
    more = F.try_variant_get(listed, "$[2]", "variant").isNotNull()
    return F.when((F.try_variant_get(listed, "$[1]", "int") == 7) & ~more, listed)


def _rise(text: Column) -> Column:
    """Brackets opened less brackets closed, outside strings."""
    bare = F.regexp_replace(text, STRINGS, "")
    return F.length(F.translate(bare, "]}", "")) - F.length(F.translate(bare, "[{", ""))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of all files with their ``place``, and the state before (``inside``, ``depth``) and behind them."""
    pieces = spark.read.text(path, lineSep="}").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"),
    )
    even = _outside(F.col("value"))
    # The brace that ended the piece counts where it is outside a string.
    marked = pieces.select(
        "*", (~even).cast("int").alias("odd"),
        (_rise(F.col("value")) - even.cast("int")).alias("out"),
        (_rise(F.concat(F.lit('"'), "value")) - (~even).cast("int")).alias("in"),
    )
    before = Window.partitionBy("file", "start").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda name, window: F.coalesce(F.sum(name).over(window), F.lit(0))
    turned = marked.withColumn("turned", total("odd", before) % 2 == 1)
    # Both cases: the block is entered outside a string (0), or inside one (1).
    both = turned.select(
        "*", F.when(F.col("turned"), F.col("in")).otherwise(F.col("out")).alias("rise0"),
        F.when(F.col("turned"), F.col("out")).otherwise(F.col("in")).alias("rise1"),
    )
    # Stored, so that the texts are searched once.
    state = settled(spark, lambda: both.select(
        "*", total("rise0", before).alias("depth0"), total("rise1", before).alias("depth1"),
        F.col("value").rlike(r"\A\s*\[").alias("listed"),
    ), "pieces")
    blocks = state.groupBy("file", "start").agg(
        (F.sum("odd") % 2).alias("odd"), F.sum("rise0").alias("rise0"), F.sum("rise1").alias("rise1"),
        F.min_by("listed", "line").alias("array"),
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("entered", total("odd", earlier) % 2 == 1)
    blocks = blocks.withColumn("rise", F.when(F.col("entered"), F.col("rise1")).otherwise(F.col("rise0")))
    # One row per block; stored, so that the planner knows its size and need not shuffle the texts.
    entry = staged(blocks.select(
        "file", "start", "entered", total("rise", earlier).alias("level"),
        F.min_by("array", "start").over(Window.partitionBy("file")).alias("array"),
    ), "entry")
    case = lambda name: F.when(F.col("entered"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    return state.join(entry, ["file", "start"]).select(
        "file", "size", F.struct("start", "line").alias("place"), "start", "line", "value", "array",
        (F.col("entered") != F.col("turned")).alias("inside"), (F.col("level") + case("depth")).alias("depth"),
        (F.col("level") + case("depth") + case("rise")).alias("behind"),
        ((F.col("entered") != F.col("turned")) != (F.col("odd") == 1)).alias("inside_behind"),
    )


def _opening() -> Column:
    """For a piece that opens the array of records: what is before the array's elements, and what follows."""
    parts = F.split("value", DATA)
    left = lambda k: F.array_join(F.slice(parts, 1, k), '"data":[')
    whole = lambda k: F.concat(F.when(F.col("inside"), '"').otherwise(""), left(k))
    # The member counts only where one bracket, that of the whole object, is open.
    here = F.filter(
        F.sequence(F.lit(1), F.size(parts) - 1),
        lambda k: _outside(whole(k)) & (F.col("depth") + _rise(whole(k)) == 1),
    )
    k = F.get(here, 0)
    member = F.when(~F.col("array") & F.col("value").rlike(DATA), F.when(F.size(here) > 0, F.struct(
        F.concat(left(k), F.lit('"data":[')).alias("head"),
        F.array_join(F.slice(parts, k + 1, F.size(parts)), '"data":[').alias("tail"),
    )))
    first = F.col("array") & (F.col("depth") == 0) & F.col("value").rlike(ARRAY)
    return F.when(first, F.struct(F.lit("[").alias("head"), F.regexp_replace("value", ARRAY, "").alias("tail"))).otherwise(member)


def split_documents(spark: SparkSession, path: str, largest: int) -> tuple[set[str], str]:
    """The kinds of the files' documents (``array``, ``wrapped``) and a folder with their records as lines.

    A file over ``largest`` bytes that holds neither an array of objects nor one under ``data`` is refused, and one that
    is no JSON outside its records; whether a record is JSON shows when its line is read. Smaller files without such
    an array have no lines; whether they hold a document is for the caller to tell.
    """
    lines = new_path(spark, "records")
    with collecting() as paths:
        placed = _placed(spark, path)
        # The records' objects end where just the array, and under a member the whole object, is open.
        base = F.when(F.col("array"), 1).otherwise(2)
        marks = staged(placed.select(
            "file", "place", _opening().isNotNull().alias("opens"),
            (~F.col("inside") & (F.col("depth") == base) & F.col("value").rlike(r"\A\s*\]")).alias("closes"),
        ).where(F.col("opens") | F.col("closes")), "marks")
        opened = marks.where("opens").groupBy("file").agg(F.min("place").alias("opened"), F.count(F.lit(1)).alias("openings"))
        closed = marks.where("closes").join(opened.select("file", "opened"), "file").where("place > opened").groupBy("file").agg(
            F.min("place").alias("closed")
        )
        # One row per file.
        bounds = staged(opened.join(closed, "file", "left"), "bounds")
        within = placed.join(bounds, "file", "left")
        record = F.coalesce((F.col("place") >= F.col("opened")) & (F.col("place") < F.col("closed")), F.lit(False))
        kinds = _checked(within, record, largest)

        ends = ~F.col("inside_behind") & (F.col("behind") == base)
        starts = F.col("place") == F.col("opened")
        value = F.when(starts, F.concat(F.lit(","), _opening()["tail"])).otherwise(F.col("value"))
        alone = ends & ~F.col("inside") & (F.col("depth") == base)
        inner = within.where(record)
        single = inner.where(alone).select(value.alias("value"))
        # Which records the other pieces belong to is found without the texts.
        upto = Window.partitionBy("file", "start").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
        earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        places = staged(inner.select(
            "file", "start", "line", alone.alias("alone"), F.when(ends, F.col("place")).alias("ended")
        ).withColumn("last", F.max("ended").over(upto)), "places")
        # A record that goes on from an earlier block follows the last one ended there.
        carried = places.groupBy("file", "start").agg(F.max("ended").alias("last")).select(
            "file", "start", F.max("last").over(earlier).alias("carried")
        )
        owner = places.where(~F.col("alone")).join(carried, ["file", "start"]).select(
            "file", "start", "line", F.coalesce("last", "carried").alias("last")
        )
        parts = inner.where(~alone).select("file", "start", "line", value.alias("value")).join(
            owner, ["file", "start", "line"]
        ).groupBy("file", "last").agg(F.sort_array(F.collect_list(F.struct("start", "line", "value"))).alias("pieces"))
        texts = single.unionByName(parts.select(F.array_join("pieces.value", "}").alias("value")))
        proper = F.col("value").rlike(r"\A\s*,\s*\{") & ~F.regexp_replace("value", PROPER, "").contains('"')
        text = F.concat(F.translate(F.regexp_replace("value", r"\A\s*,\s*", ""), "\r\n", "  "), F.lit("}"))
        wrong = F.concat(F.lit("an array of records holds what is no object: "), F.substring("value", 1, 80))
        texts.select(F.when(proper, text).otherwise(F.raise_error(wrong).cast("string")).alias("value")).write.text(lines)
    release(spark, paths)
    return kinds, lines


def _checked(within: DataFrame, record: Column, largest: int) -> set[str]:
    """The kinds of documents, after a look at what is around the records of each file."""
    around = F.when(F.col("place") == F.col("opened"), _opening()["head"]).otherwise(F.col("value"))
    outer = ~record | (F.col("place") == F.col("opened"))
    # A file without an array of records has all its text around them; it is not put together.
    kept = outer & F.col("opened").isNotNull()
    length = F.sum(F.when(kept, F.octet_length(around)).otherwise(0))
    sizes = within.groupBy("file", "size").agg(
        (F.sum(F.octet_length("value") + 1) - F.max("size")).alias("beyond"), length.alias("around"),
        F.max("openings").alias("openings"), F.max("closed").isNotNull().alias("closed"), F.max("array").alias("array"),
    )
    short = sizes.where((F.col("around") <= AROUND) & F.col("closed"))
    envelope = within.where(kept).join(short.select("file"), "file", "left_semi").groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("place", around.alias("text"), (F.col("place") == F.col("opened")).alias("head")))).alias("p")
    )
    # Pieces are put together with the braces between them, but the array itself is left empty.
    joined = F.aggregate("p", F.lit(""), lambda s, x: F.concat(s, x["text"], F.when(x["head"], "").otherwise("}")))
    checked = sizes.join(envelope.select("file", joined.alias("text")), "file", "left")
    # The last piece of a file has no brace behind it, unless the file's length tells that it has.
    cut = F.expr("left(text, length(text) - 1)")
    valid = lambda text: sole_document(text).isNotNull()
    sound = F.when(F.col("beyond") == 0, valid(F.col("text"))).when(F.col("beyond") == 1, valid(cut)).otherwise(
        valid(F.col("text")) | valid(cut)                                # a compressed file tells no length
    )
    kind = (
        F.when(F.col("openings").isNull(), F.when(F.col("size") > largest, "other").otherwise("small"))
        .when((F.col("openings") > 1) & ~F.col("array"), "twice").when(~F.col("closed"), "broken")
        .when(F.col("around") > AROUND, "around").when(~F.coalesce(sound, F.lit(False)), "broken")
        .otherwise(F.when(F.col("array"), "array").otherwise("wrapped"))
    )
    found = {r["kind"]: r["file"] for r in checked.select("file", kind.alias("kind")).groupBy("kind").agg(F.min("file").alias("file")).collect()}
    if "twice" in found:
        raise ValueError(f"{found['twice']} is malformed, or an object in it has two members of one name")
    if "broken" in found:
        raise ValueError(f"{found['broken']} is no single JSON document; read lines of JSON with lines=True")
    if "around" in found:
        raise ValueError(f"{found['around']} holds over {AROUND >> 20} MiB beside its records; write them as lines and read them with lines=True")
    if "other" in found:
        raise ValueError(
            f"{found['other']} is one document of over {largest >> 20} MiB that is neither an array of records nor one under "
            "data; write its records as lines and read them with lines=True"
        )
    return set(found) - {"small"}
