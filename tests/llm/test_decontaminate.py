"""Matches against a plain dynamic program over every document and item."""

import random

import pytest

from kempt.llm import decontaminate as dc
from kempt.llm.queries import QUERIES


def sellers(pattern, text):
    """The least edit distance between a pattern and any part of a text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def brute(docs, items, rate=dc.RATE, least=dc.MIN_CHARS):
    found = {}
    for d, text in docs:
        t = dc.normalized(text)
        for i, item in items:
            p = dc.normalized(item)
            if len(p) >= least and (distance := sellers(p, t)) <= int(rate * len(p)):
                found[d, i] = min(distance, found.get((d, i), distance))
    return found


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        match rng.randrange(3):
            case 0: chars[at] = rng.choice("xyzé")
            case 1: chars.insert(at, rng.choice("xyzé"))
            case _: del chars[at]
    return "".join(chars)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(2, 8)))
    items = [(k, " ".join(word() for _ in range(14)).upper()) for k in range(6)] + [(7, "too short"), (8, None), (9, ""), (0, " ".join(word() for _ in range(15)))]
    docs = [(0, None), (1, ""), (2, "  \n ")]
    for k in range(40):
        item = dc.normalized(items[k % 6][1])
        text = edited(rng, item, rng.randrange(0, 12))
        docs.append((10 + k, " ".join(word() for _ in range(20)) + "\n\t" + text.replace(" ", "\n") + " " + " ".join(word() for _ in range(10))))
    docs.append((99, items[0][1] + items[1][1] * 2 + (items[9][1])))
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_like_a_plain_search(spark, cases, block_bytes):
    docs, items = cases
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, item_id int")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, distance int")
    rows = dc.find(d, i, block_bytes=block_bytes).collect()
    expected = brute(docs, items)
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in rows} == expected and len(rows) == len(expected) > 20
    kept = dc.keep_clean(d, i, block_bytes=block_bytes)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {k for k, _ in docs} - {k for k, _ in expected}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "text " * 30)], docs.schema)
    assert dc.find(docs, items).collect() == [] and dc.find(some, items).collect() == []
    assert dc.find(docs, some.withColumnRenamed("doc_id", "item_id")).collect() == []
    assert dc.keep_clean(some, items).count() == 1


def test_repeated_rows_and_a_long_text(spark):
    item = "an item of the benchmark that is to be found again"
    d = spark.createDataFrame([(1, "y " * 60_000 + item + " z" * 60_000)] * 2 + [(2, "no")], "doc_id bigint, text string")
    i = spark.createDataFrame([(5, item)] * 3, "item_id bigint, text string")
    assert [(r["doc_id"], r["item_id"], r["distance"]) for r in dc.find(d, i).collect()] == [(1, 5, 0)]


def test_query_finds_every_whole_item(spark, folder):
    docs = [(r["doc_id"], dc.normalized(r["text"])) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], dc.normalized(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op9_decontaminate"](spark, folder).collect()}
    whole = {(d, i) for d, t in docs for i, p in items if p in t}
    assert whole == {k for k, distance in found.items() if distance == 0}
    # Those with edits, and a number of short documents, by the plain search.
    some = [r for r in docs if len(r[1]) < 450][:15] + [r for r in docs if any(k[0] == r[0] and found[k] for k in found)][:3]
    assert {k: v for k, v in found.items() if k[0] in dict(some)} == brute(some, items)


def test_short_items_occur_exactly_as_whole_words(spark):
    items = [(1, "What is  2+2?"), (2, "capital of Peru"), (3, " "), (4, "a" * 31), (5, "b" * 32)]
    docs = [
        (1, "so WHAT\nis 2+2?yes"), (2, "what is 2+3?"), (3, "the capital of peru."), (4, "capital of peruvians"),
        (5, "xcapital of peru, then the capital of Peru"), (6, "a" * 31), (7, "a" * 30), (8, "a" * 32), (9, "b" * 31), (10, ""),
    ]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    expected = {(1, 1, 0, 15), (3, 2, 0, 19), (5, 2, 0, 42), (6, 4, 0, 31), (9, 5, 1, 31)}
    assert set(map(tuple, dc.find(d, i).collect())) == expected
    assert {r["doc_id"] for r in dc.keep_clean(d, i).collect()} == {k for k, _ in docs} - {k for k, *_ in expected}
