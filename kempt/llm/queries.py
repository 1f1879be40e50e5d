"""The registered queries of the operators of this package, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import new_path
from . import (
    bpe, byte_dedup, decontaminate, jaccard_join, language, line_dedup, periodic, pii, quality_model, risk_rules, shard_tree, warc,
    whitening,
)
from .frames import documents, map_texts

TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op7_shard_tree(spark, folder):
    sharded = shard_tree.shard(documents(spark, folder), shards=40)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op5_pii(spark, folder):
    found = pii.find(documents(spark, folder))
    base = [k.name for k in pii.KINDS if k.base]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def digest(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(digest(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"), F.transform("spans", lambda s: s["score"]).alias("scores"),
    )


def remainder(divisor: int) -> Column:
    """The part of the held-out split that a document belongs to."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor


def tokenizer_path() -> str:
    """Where the public vocabulary file lies; the same package is installed on the executors."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@query
def op4_bpe(spark, folder):
    return bpe.digests(documents(spark, folder), tokenizer_path())


@query
def op6_risk_rules(spark, folder):
    judged = risk_rules.judge(documents(spark, folder), documents(spark, folder, "labels"))
    return judged.select("doc_id", *risk_rules.MEASURES[:5], "base_failed", "kept", "stratum", "failed")


@query
def op3_quality_model(spark, folder):
    docs, labels = documents(spark, folder), documents(spark, folder, "labels")
    weights = quality_model.fit(docs, labels, remainder(3) != 1)
    return quality_model.score(docs, weights).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op8_language(spark, folder):
    docs = documents(spark, folder)
    model = language.fit(docs, remainder(4) != 2)
    return language.identify(docs, model).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


@query
def op1_warc(spark, folder):
    path = new_path(spark, "warc")
    warc.write_warc(documents(spark, folder, "pages"), path)
    page = lambda name: F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")
    return warc.read_warc(spark, path, payloads=False).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )


@query
def op2_line_dedup(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    deduped, runs = line_dedup.dedup(docs)
    removed = F.aggregate(F.col(runs), F.lit(0), lambda n, r: n + r["end"] - r["first"])
    ranges = F.array_join(F.transform(F.col(runs), lambda r: F.concat_ws(":", r["first"], r["end"])), ",")
    return deduped.select(
        "doc_id", F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed_lines"),
        F.coalesce(ranges, F.lit("")).alias("removed"), "text",
    )


@query
def op9_decontaminate(spark, folder):
    found = decontaminate.find(documents(spark, folder), documents(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "distance")


@query
def op10_jaccard_join(spark, folder):
    return jaccard_join.groups(documents(spark, folder))


def repeating(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: about every tenth text ends with copies of a block of its words; a null key's stays as it is.

    Which text, where the copies start and how long the block is follow from the key alone.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def changed(key, text: str | None) -> str | None:
        h = zlib.crc32(str(key).encode())
        if key is None or h % 10:
            return text
        words = periodic.words_of(text)
        if not words:
            return text
        first, left = h // 10 % len(words), len(words) - h // 10 % len(words)
        block = words[first:first + 1 + left // (3 + h // 10 % 8)]
        copies = (block * (left // len(block) + 1))[:left]
        return b" ".join(words[:first] + copies).decode()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text": pa.array([changed(k, t) for k, t in pairs], pa.string()),
            })

    return map_texts(docs.select("doc_id", "text"), f"doc_id {kind}, text string", work)


@query
def op13_periodic(spark, folder):
    found = periodic.find(repeating(documents(spark, folder)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_whitening(spark, folder):
    points = whitening.on_grid(documents(spark, folder, "embeddings"), "vec_id", "embedding", scale=64, offset=1_000_000)
    model = whitening.fit(points, components=32)
    error = whitening.identity_error(points, model) if model else None
    return whitening.apply(points, model, "vec_id").withColumn("identity_error", F.lit(error).cast("double"))


@query
def op11_suffix_dedup(spark, folder):
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return byte_dedup.dedup(documents(spark, folder)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
