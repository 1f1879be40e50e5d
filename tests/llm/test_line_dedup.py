"""Deleted runs against a plain search for every repeated run."""

import random

import pytest

from kempt.llm import line_dedup
from kempt.llm.queries import QUERIES


def brute(docs, min_words):
    """Per document the deleted lines: those of runs with enough words of which an equal one starts earlier."""
    docs = sorted((k, t.split("\n")) for k, t in docs if t is not None and k is not None)
    first, deleted = {}, {k: set() for k, _ in docs}
    for k, lines in docs:
        words = [len(line.split()) for line in lines]
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += words[b]
                if total >= min_words:
                    run = tuple(lines[a:b + 1])
                    if first.setdefault(run, (k, a)) != (k, a):
                        deleted[k].update(range(a, b + 1))
    return deleted


def expected(docs, min_words):
    deleted = brute(docs, min_words)
    return {
        k: t if t is None or k is None or not deleted[k] else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in deleted[k])
        for k, t in docs
    }


def result(spark, docs, min_words):
    df = spark.createDataFrame([(*r, "own", 1) for r in docs], "doc_id bigint, text string, copy string, pos int")
    out, runs = line_dedup.dedup(df, min_words)
    assert out.columns == [*df.columns, runs]
    return {r["doc_id"]: r["text"] for r in out.collect()}


CASES = {
    "odd rows": [(1, None), (2, ""), (3, "a b c"), (4, "a b c"), (5, "\n\n"), (6, "a b c\n\na b c"), (None, "a b c")],
    "runs": [(1, "x y\nz\nq"), (2, "p\nx y\nz\nr"), (3, "z\nq"), (4, "x y\nz\nq"), (5, "x y\nx y\nx y\nx y")],
    "tails": [(1, "a b c d\ne\nf\n\ng"), (2, "a b c d\ne\nf\n\ng"), (3, "h\na b c d\ne\nf\n\n"), (4, "e\nf\n\ng")],
    "long": [(1, "\n".join(f"l{i % 17}" for i in range(300))), (2, "\n".join(f"l{i % 17}" for i in range(250)))],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("min_words", [1, 3])
def test_like_a_plain_search(spark, name, min_words):
    assert result(spark, CASES[name], min_words) == expected(CASES[name], min_words)


def test_random_documents(spark):
    rng = random.Random(3)
    lines = ["a", "b b", "c c c", "", "d d d d d", "e"]
    docs = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 14)))) for k in range(60)]
    for min_words in (2, 6):
        assert result(spark, docs, min_words) == expected(docs, min_words)


def test_repeated_rows_are_one_document(spark):
    docs = [(1, "a b c\nd"), (1, "a b c\nd"), (2, "a b c\nd")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    out, _ = line_dedup.dedup(df, 3)
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [(1, "a b c\nd"), (1, "a b c\nd"), (2, "")]


def test_empty_table(spark):
    out, _ = line_dedup.dedup(spark.createDataFrame([], "doc_id bigint, text string"))
    assert out.collect() == []


def test_query_over_the_whole_table(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op2_line_dedup"](spark, folder).collect()
    assert {r["doc_id"]: r["text"] for r in found} == expected(docs, 50)
    deleted = brute(docs, 50)
    assert {r["doc_id"]: r["n_removed_lines"] for r in found} == {k: len(v) for k, v in deleted.items()}
