"""Read CSV, JSON and Parquet tables; the file extension picks the reader."""

from __future__ import annotations

import csv
import io
import json
import re
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.columns import col
from ..operators.staging import settled
from .documents import sole_document, split_documents
from .flatten import flatten

FORMATS = {"csv": "csv", "json": "json", "jsonl": "jsonl", "ndjson": "jsonl", "parquet": "parquet"}

# Fixed value: the text of a missing cell in CSV files.
CSV_MISSING = "NA"

# A line read from the start of a record ends all its cells: quoted ones close, others do not start with a quote. What follows a
# closing quote up to the comma belongs to its cell. Possessive, so that long lines need no stack.
QUOTED_REST = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
CELL = rf'(?:"{QUOTED_REST}|[^",][^,]*+|)'
WHOLE_LINE = rf"\A{CELL}(?:,{CELL})*+\z"
# A line read from inside a quoted cell closes it, and ends all cells behind it.
CLOSING_LINE = rf"\A{QUOTED_REST}(?:,{CELL})*+\z"

# The longest document that one task reads as a whole; longer ones are split into their records.
LARGEST_DOCUMENT = 128 << 20
# Two members of one name with nothing but scalars between them.
TWICE = r'(?s)("(?:[^"\\]|\\.)*+")\s*+:[^{}]*,\s*+\1\s*+:'

# Fixed value: texts of numbers.
NUMBER = r"\A[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|NaN|Inf(?:inity)?)\z"


def load_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Read a file or a folder of files. ``fmt`` overrides the extension of ``path``."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    extension = (fmt or (name.rsplit(".", 1)[-1] if "." in name else "")).lower()
    match FORMATS.get(extension):
        case "csv":
            return read_csv(spark, path, **options)
        case "json":
            return read_json(spark, path, **options)
        case "jsonl":
            return read_json(spark, path, lines=True, **options)
        case "parquet":
            return spark.read.parquet(literal(spark, path))
    raise ValueError(f"unsupported file format {extension!r}; use one of {', '.join(FORMATS)}")


def literal(spark: SparkSession, path: str) -> str:
    """A path whose marks would be read as a pattern, escaped if a file or folder has exactly this name."""
    if not re.search(r"[\\*?\[\]{}]", path):
        return path
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = name.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path) if system.exists(name) else path


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV with a header. ``NA`` is missing everywhere; a blank is missing except in text.

    Names are those of the header, repeated ones too. Types are inferred over all files at once (numbers and booleans; a
    column without any value and dates are text) unless a schema is given, which saves a pass; then a cell that is not
    missing and does not fit its type is an error. All files must have the same header. Short rows are filled with
    missing cells; rows with more cells than the header are an error. Quoted cells may span lines. Files stay split over
    many tasks, those with such cells too: there, lines are put together by ``_records`` and stored in the shared folder.
    ``multi_line=None`` looks for them, a pass that reads lines only; False says that there are none, True that any file may have some.
    """
    path = literal(spark, path)
    headers, spanning = _surveyed(spark, path, multi_line)
    records = None
    if spanning or multi_line:
        lines = _lines(spark, path)
        # Stored, so that headers, types and cells do not each put the records together.
        records = settled(spark, lambda: _records(lines if multi_line else lines.where(F.col("file").isin(spanning))), "records")
    if records is not None:
        headers |= {r["value"] for r in records.where("heading").select("value").distinct().limit(2).collect()}
    names = {tuple(next(csv.reader(io.StringIO(h, newline="")), [])) for h in headers}
    if len(names) > 1:
        raise ValueError(f"the headers of the files in {path} differ: {' and '.join(sorted(map(repr, names))[:2])}")
    if not names:
        raise ValueError(f"there is no file with a line in {path}")
    header = [n if n else f"_c{i}" for i, n in enumerate(names.pop())]
    if schema is not None:
        # DDL text is turned into a schema by an empty table.
        fields = (spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema).fields
        if len(fields) != len(header):
            raise ValueError(f"the schema has {len(fields)} columns, the header {len(header)}")
    places = [f"c{i}" for i in range(len(header))]
    # One column more: it is filled only where a row has more cells than the header.
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*places, "beyond"]])
    # Blanks come back as null and NA as text; told apart here, per type.
    options = {"escape": '"', "nullValue": "", "emptyValue": ""}
    parts = []
    if not multi_line:
        plain = spark.read.options(header=True, enforceSchema=True, **options).schema(text).csv(path)
        parts.append(plain.where(~F.col("_metadata.file_path").isin(spanning)) if spanning else plain)
    if records is not None:
        body = records.where(~F.col("heading") & (F.trim("value") != ""))
        parts.append(body.select(F.from_csv("value", ", ".join(f"{f.name} string" for f in text), options).alias("r")).select("r.*"))
    cells = reduce(DataFrame.unionAll, parts)
    fits = F.when(F.col("beyond").isNull(), True).otherwise(
        F.raise_error(F.concat(F.lit("a CSV row has more cells than the header; the next one holds "), "beyond")).cast("boolean")
    )
    cells = cells.where(fits)
    strict = schema is not None
    if not strict:
        fields = _inferred(cells, places, header)
    return cells.select(*[_cell(F.col(n), f, strict).alias(f.name) for n, f in zip(places, fields)])


def _inferred(cells: DataFrame, places: list[str], names: list[str]) -> list[T.StructField]:
    """The narrowest type that all cells of a column fit, over all files: integer, long, double, boolean, else text."""
    tests = {
        T.IntegerType(): lambda c: c.rlike(r"\A[+-]?[0-9]+\z") & c.try_cast("int").isNotNull(),
        T.LongType(): lambda c: c.rlike(r"\A[+-]?[0-9]+\z") & c.try_cast("bigint").isNotNull(),
        T.DoubleType(): lambda c: c.rlike(NUMBER),
        T.BooleanType(): lambda c: F.lower(c).isin("true", "false"),
    }
    counts = []
    for n in places:
        cell = F.trim(F.col(n))
        value = F.when((cell != "") & (cell != CSV_MISSING), cell)
        counts += [F.count(value).alias(f"{n}_n"), *[F.count_if(F.coalesce(test(value), F.lit(False))).alias(f"{n}_{k}")
                                                    for k, test in enumerate(tests.values())]]
    found = cells.agg(*counts).first()
    kind = lambda n: next(
        (t for k, t in enumerate(tests) if found[f"{n}_n"] and found[f"{n}_{k}"] == found[f"{n}_n"]), T.StringType()
    )
    return [T.StructField(name, kind(n)) for name, n in zip(names, places)]


def _cell(c, field: T.StructField, strict: bool):
    if isinstance(field.dataType, T.StringType):
        return F.when(c.isNull() | (c != CSV_MISSING), F.coalesce(c, F.lit("")))
    value = F.trim(c).try_cast(field.dataType)
    if not strict:
        return value
    wrong = F.concat(F.lit(f"a cell of {field.name!r} is no {field.dataType.simpleString()}: "), c)
    missing = c.isNull() | (F.trim(c) == "") | (F.trim(c) == CSV_MISSING)
    return F.when(missing | value.isNotNull(), value).otherwise(F.raise_error(wrong).cast(field.dataType))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, start, line``: the lines, the block of the file they were read from, and their order in it."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )


def _surveyed(spark: SparkSession, path: str, multi_line: bool | None) -> tuple[set[str], list[str]]:
    """Up to two different first lines, and the files in which a quoted cell may span lines; by one pass over the lines.

    Where every line, taken for itself, ends all its cells, each line starts a record, so none spans lines; stray quotes
    inside unquoted cells do not matter. First lines of files with spanning cells are not among those returned.
    """
    if multi_line:
        return set(), []
    unsure = F.col("value").contains('"') & ~F.col("value").rlike(WHOLE_LINE)
    first = F.min_by("value", F.when((F.col("start") == 0) & (F.trim("value") != ""), F.col("line")))
    spans = F.lit(False) if multi_line is False else F.coalesce(F.bool_or(unsure), F.lit(False))
    files = _lines(spark, path).groupBy("file").agg(first.alias("first"), spans.alias("spans"))
    # One row per file with spanning cells and per different header.
    found = files.groupBy("spans", F.when(F.col("spans"), F.col("file")).otherwise(F.col("first")).alias("what")).count().collect()
    return {r["what"] for r in found if not r["spans"] and r["what"] is not None}, [r["what"] for r in found if r["spans"]]


def _records(lines: DataFrame) -> DataFrame:
    """``value, heading``: the records of files whose quoted cells may span lines, and whether they are a file's first.

    Each line maps the state before it (outside or inside a quoted cell) to the state behind it. It either always leaves
    the same state, or keeps it, or swaps it; so the state before a line follows from the last line that sets it and
    the number of swaps since, first inside each block of a file, then over its blocks. So a large file is read by
    many tasks. Only lines of records that span lines are put together; records of one line pass.
    """
    quotes = F.col("value").contains('"')
    opens = quotes & ~F.col("value").rlike(WHOLE_LINE)                  # read from outside, the line ends inside
    stays = ~quotes | ~F.col("value").rlike(CLOSING_LINE)               # read from inside, the line ends inside
    marked = lines.select("value", "file", "start", "line", opens.alias("opens"), stays.alias("stays"))
    before = Window.partitionBy("file", "start").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, 0)

    def through(rows: DataFrame, window, suffix: str) -> list[Column]:
        """The last state set in the window (null: none), and the swaps since, modulo 2."""
        swaps = F.sum(F.when(F.col("swap"), 1).otherwise(0)).over(window)
        last = F.max(F.when(F.col("set").isNotNull(), F.struct("order", "set", "swaps"))).over(window)
        since = F.coalesce(swaps, F.lit(0)) - F.coalesce(last["swaps"], F.lit(0))
        return [last["set"].alias(f"set{suffix}"), (since % 2 == 1).alias(f"swapped{suffix}")]

    # At a line that sets the state, the swaps counted are those before it.
    swap = F.col("opens") & ~F.col("stays")
    counted = marked.select(
        "*", swap.alias("swap"), F.when(F.col("opens") == F.col("stays"), F.col("opens")).alias("set"), F.col("line").alias("order"),
        F.coalesce(F.sum(F.when(swap, 1).otherwise(0)).over(before), F.lit(0)).alias("swaps"),
    )
    state = counted.select("*", *through(counted, before, "_before"), *through(counted, upto, "_after"))
    blocks = state.groupBy("file", "start").agg(
        F.max_by(F.struct(F.col("set_after").alias("set"), F.col("swapped_after").alias("swap")), "line").alias("m")
    ).select("file", "start", "m.set", F.when(F.col("m.set").isNull(), F.col("m.swap")).otherwise(False).alias("swap"),
             F.col("m.swap").alias("also"), F.col("start").alias("order"))
    # A block that sets the state leaves what it sets, swapped or not.
    blocks = blocks.withColumn("set", F.col("set") != F.col("also"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("swaps", F.coalesce(F.sum(F.when(F.col("swap"), 1).otherwise(0)).over(earlier), F.lit(0)))
    entered = blocks.select("file", "start", *through(blocks, earlier, ""))
    # A file begins outside.
    entered = entered.select("file", "start", (F.coalesce("set", F.lit(False)) != F.col("swapped")).alias("entered"))
    placed = state.join(entered, ["file", "start"]).withColumn(
        "inside", F.coalesce("set_before", "entered") != F.col("swapped_before")
    )
    filled = F.trim("value") != ""
    heading = (F.col("start") == 0) & filled & (F.coalesce(F.count(F.when(filled, 1)).over(before), F.lit(0)) == 0)
    begun = F.when(~F.col("inside"), F.struct("start", "line"))
    own = placed.select(
        "file", "start", "line", "value", "inside", (~F.col("inside") & ~F.col("opens")).alias("single"), heading.alias("heading"),
        F.max(begun).over(upto).alias("begun"),
    )
    single = own.where("single").select("value", "heading")
    # A record that goes on from an earlier block belongs to the last one begun there.
    last = own.groupBy("file", "start").agg(F.max("begun").alias("last")).select(
        "file", "start", F.max("last").over(earlier).alias("carried")
    )
    parts = own.where(~F.col("single")).join(last, ["file", "start"]).groupBy(
        "file", F.coalesce("begun", "carried").alias("begun")
    ).agg(F.sort_array(F.collect_list(F.struct("start", "line", "value", "heading"))).alias("lines"))
    return single.unionByName(parts.select(
        F.array_join("lines.value", "\n").alias("value"), F.element_at("lines.heading", 1).alias("heading")
    ))


def read_json(
    spark: SparkSession,
    path: str,
    lines: bool = False,
    schema: T.StructType | str | None = None,
    layout: str | None = None,
    largest: int = LARGEST_DOCUMENT,
) -> DataFrame:
    """JSON records, records under ``data``, or an object of arrays; nested objects flattened.

    One document per file is read as a whole up to ``largest`` bytes. A longer array of records, also under
    ``data``, is split over many tasks and its records are stored as lines first; so are then those of the shorter files
    beside it. With ``lines`` every line is a document of its own and files are split, which is the form for large data.
    A file that holds no JSON, several documents or no table is an error. ``layout``
    (records, wrapped, columnar) says how all documents are laid out; without it the documents themselves tell, and
    files of different layouts are an error. Among lines, only a sole member ``data`` makes records under ``data``.
    """
    path = literal(spark, path)
    read = spark.read.options(multiLine=not lines, mode="FAILFAST")
    if not lines:
        # Many files take long to list, so they are listed once for all looks at them.
        files = spark.read.text(path, wholetext=True).select("value", "_metadata.file_path", "_metadata.file_size")
        whole = files.where(F.col("file_size") <= largest)
        kinds = _document_kinds(whole)
        # The length of a file is known without reading it.
        if not files.where(F.col("file_size") > largest).select("file_size").isEmpty():
            split, records = split_documents(spark, path, largest)
            told = _layout(T.StructType(), kinds | split)
            if layout not in (None, told):
                raise ValueError(f"a document in {path} is too long for the layout {layout}; it is {told}")
            if schema is not None and told == "wrapped":
                # The schema is that of the document, its records are read apart.
                schema = spark.createDataFrame([], schema).select(F.inline("data")).schema
            path, layout, read = records, "records", spark.read.options(mode="FAILFAST", allowSingleQuotes=False)
            lines = True
    try:
        if schema is None and not lines:
            schema = _document_schema(spark, whole.select("value"))
        raw = (read.schema(schema) if schema is not None else read).json(path)
    except (PySparkException, Py4JJavaError) as fault:
        raise ValueError(f"the JSON data is malformed or holds no table: {fault}") from fault
    if raw.columns == ["_corrupt_record"] or not raw.columns:
        raise ValueError("the JSON data does not hold a table")
    if layout is None:
        layout = _line_layout(raw.schema) if lines else _layout(raw.schema, kinds)
    if layout == "records":
        return flatten(raw)
    if layout == "wrapped":
        return flatten(raw.select(F.inline("data")))
    if layout == "columnar":
        return flatten(_columnar(flatten(raw)))
    raise ValueError(f"unknown JSON layout: {layout!r}")


def _document_schema(spark: SparkSession, texts: DataFrame) -> T.StructType:
    """The schema of documents given as texts, which are spread over tasks by number too.

    The reader's own look at files of many lines packs small files into one task and hands it the names of all files
    with each of them, so its time grows with the square of their number.
    """
    documents = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = spark._jsparkSession.read().option("mode", "FAILFAST").json(documents).schema()
    return T.StructType.fromJson(json.loads(found.json()))


def _document_kinds(whole: DataFrame) -> set[str]:
    """What the files' documents are: ``array``, ``wrapped`` or ``object``. Each file must hold exactly one."""
    # Longer ones are told apart by ``split_documents``; the filter kept their files from being opened.
    listed = sole_document(F.col("value"))
    first = F.try_variant_get(listed, "$[0]", "variant")
    one = F.schema_of_variant(first)
    data = F.schema_of_variant(F.try_variant_get(listed, "$[0].data", "variant"))
    kind = (
        F.when(first.isNull() | ~F.is_valid_utf8("value"), "broken")
        .when(one.startswith("ARRAY<OBJECT<"), "array").when(one == "ARRAY<VOID>", "array")
        .when(data.startswith("ARRAY<OBJECT<"), "wrapped").when(one.startswith("OBJECT<"), "object").otherwise("none")
    )
    # Why a text is no document: too long, a member twice, or else malformed or several.
    reason = F.when(kind == "broken", F.when(F.octet_length("value") > LARGEST_DOCUMENT, "large").when(
        F.col("value").rlike(TWICE), "twice").otherwise("broken")).otherwise(kind)
    files = whole.select(reason.alias("kind"), F.col("file_path").alias("file"))
    found = {r["kind"]: r["file"] for r in files.groupBy("kind").agg(F.min("file").alias("file")).collect()}
    if "large" in found:
        raise ValueError(
            f"{found['large']} is one document of over {LARGEST_DOCUMENT >> 20} MiB; write its records as lines and read them "
            "with lines=True"
        )
    if "twice" in found:
        raise ValueError(f"{found['twice']} is malformed, or an object in it has two members of one name")
    if "broken" in found:
        raise ValueError(f"{found['broken']} is no single JSON document; read lines of JSON with lines=True")
    if "none" in found:
        raise ValueError(f"the JSON data of {found['none']} does not hold a table")
    return set(found)


def _is_array(dtype: T.DataType, of=T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, of)


def _layout(schema: T.StructType, kinds: set[str]) -> str:
    if len(kinds) > 1:
        raise ValueError(f"the JSON files differ in layout: {', '.join(sorted(kinds))}; read them apart")
    if kinds == {"wrapped"}:
        return "wrapped"
    columnar = any(_is_array(f.dataType) for f in _leaf_fields(schema))
    return "columnar" if kinds == {"object"} and columnar else "records"


def _line_layout(schema: T.StructType) -> str:
    fields = {f.name: f.dataType for f in schema.fields}
    if list(fields) == ["data"] and _is_array(fields["data"], T.StructType):
        return "wrapped"
    # A record may well hold an array; one whole object of arrays is columns.
    return "columnar" if all(_is_array(t) for t in fields.values()) else "records"


def _leaf_fields(schema: T.StructType):
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _leaf_fields(f.dataType)
        else:
            yield f


def _columnar(df: DataFrame) -> DataFrame:
    """Each document's arrays side by side. A scalar, or an array that fits a whole number of
    times into the longest, is repeated; other lengths are refused."""
    arrays = [f.name for f in df.schema.fields if _is_array(f.dataType)]
    sizes = [F.size(col(c)) for c in arrays]
    rows = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    fits = F.lit(True)
    for size in sizes:
        fits = fits & ((size == rows) | ((size > 0) & (rows % F.greatest(size, F.lit(1)) == 0)))
    cells = lambda i: F.struct(*[
        (F.get(col(c), i % F.size(col(c))) if c in arrays else col(c)).alias(f"c{k}")
        for k, c in enumerate(df.columns)
    ])
    table = F.when(
        fits, F.when(rows > 0, F.transform(F.sequence(F.lit(0), rows - 1), cells))
    ).otherwise(F.raise_error(F.lit("the JSON arrays differ in length, so they are not a table")))
    return df.select(F.inline(table)).toDF(*df.columns)
