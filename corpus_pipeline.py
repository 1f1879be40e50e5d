"""A training corpus from documents: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kempt.llm import bpe, decontaminate, jaccard_join, language, line_dedup
from kempt.llm.frames import documents
from kempt.llm.queries import remainder, tokenizer_path
from kempt.operators.staging import collecting, release, settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language is rejected or that have no letter. Learns from three of four documents."""
    return language.keep_identified(docs, language.fit(docs, remainder(4) != 2))


def deduplicated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of line runs of 50 words or more; lengths follow the text. A document of which nothing is
    left goes: all its text stands in documents that stay. One that was empty before stays."""
    out, runs = line_dedup.dedup(docs)
    out = out.where(F.col(runs).isNull() | (F.col("text") != ""))
    changed = F.when(F.col(runs).isNotNull(), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by their shingles, however far, the one with the smallest id."""
    return jaccard_join.one_per_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which an item of the benchmark occurs."""
    return decontaminate.keep_clean(docs, documents(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document left."""
    return bpe.digests(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("line_dedup", deduplicated_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", decontaminated),
    ("bpe", encoded),
]

# The stages cannot be expressed in SQL; tests hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each stage only the result stays, until the next one is written."""
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES:
        with collecting() as made:
            docs = settled(spark, partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
        release(spark, before)
        before = made
    return docs
