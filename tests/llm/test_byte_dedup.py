"""Removed bytes against a plain count of all windows, and the suffix array against sorted suffixes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kempt.llm import byte_dedup, suffix_array
from kempt.llm.frames import staged
from kempt.llm.queries import QUERIES
from kempt.llm.suffix_array import STRING, suffix_ranks


def brute(texts, length):
    """Of each text the removed byte ranges."""
    data = [(t or "").encode() for t in texts]
    windows = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        spans = []
        for i in range(len(d) - length + 1):
            if windows[d[i:i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        out.append([tuple(x) for x in spans])
    return out


def kept(text, spans):
    data = (text or "").encode()
    return b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)], strict=True))


def texts(seed, n):
    """Random words with copied, edited and repeated passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randrange(1, 9)))
    out = []
    for _ in range(n):
        text = " ".join(word() for _ in range(rng.randrange(0, 60)))
        for _ in range(rng.randrange(4)):
            source = rng.choice([*out, text])
            a = rng.randrange(len(source) + 1)
            part = source[a:a + rng.randrange(20, 300)]
            if rng.random() < 0.3 and part:
                k = rng.randrange(len(part))
                part = part[:k] + "#" + part[k + 1:]
            b = rng.randrange(len(text) + 1)
            text = text[:b] + part + text[b:]
        if rng.random() < 0.1:
            text += rng.choice(["=", "ab", "\n", "xyz "]) * rng.randrange(10, 150)
        out.append(text)
    return out


# Few cuts, many cuts, and tasks of a few rows, so that intervals cross their edges.
@pytest.mark.parametrize("length, phrase, rows", [(40, 6, 100_000), (48, 40, 64), (64, 16, 37)])
def test_like_a_plain_count(spark, monkeypatch, length, phrase, rows):
    monkeypatch.setattr(byte_dedup, "ROWS_PER_TASK", rows)
    given = texts(length, 120)
    given += [None, "", given[3], given[3], "=" * 500, "=" * 39, "\n" * 200, "ab" * 150, "é" * 200, given[5][:length], "z" + given[7]]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(given)], "doc_id int, text string, doc string, s int")
    expected = brute(given, length)
    found = {r["doc_id"]: r for r in byte_dedup.dedup(df.repartition(4), length, phrase).collect()}
    for k, (text, spans) in enumerate(zip(given, expected, strict=True)):
        assert [tuple(x) for x in found[k]["removed"]] == spans, k
        assert bytes(found[k]["kept"]) == kept(text, spans) and found[k]["n_bytes"] == len((text or "").encode())


def test_odd_rows(spark):
    copy = "the same text " * 4
    docs = [(1, copy), (1, copy), (None, "own words, which nobody else has in this order at all"), (None, None), (None, copy), (2, "")]
    found = byte_dedup.dedup(spark.createDataFrame(docs, "doc_id bigint, text string"), 40).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], len(r["removed"]), len(r["kept"])) for r in found) == [
        (0, 0, 0, 0), (0, 53, 0, 53), (0, 56, 1, 0), (1, 56, 1, 0), (1, 56, 1, 0), (2, 0, 0, 0),
    ]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert byte_dedup.dedup(empty).collect() == []
    with pytest.raises(ValueError):
        byte_dedup.dedup(empty, length=20)


def test_suffix_array(spark):
    rng = random.Random(1)
    strings = [(k, [rng.randrange(3) for _ in range(rng.randrange(1, 30))]) for k in range(30)]
    strings += [(30, strings[3][1]), (31, [1] * 25), (32, [1] * 40)]
    df = staged(spark.createDataFrame([(s, t, [1] * len(t)) for s, t in strings], STRING))
    # Deep ones go down whole or in stretches.
    for depth in (1000, 11, 4):
        ranks = {r["s"]: r["ranks"] for r in suffix_ranks(df, depth).collect()}
        assert all(len(ranks[s]) == len(t) for s, t in strings)
        every = sorted((ranks[s][i], t[i:i + depth]) for s, t in strings for i in range(len(t)))
        assert [k for _, k in every] == sorted(k for _, k in every)
        assert all(a[0] < b[0] or a[1] == b[1] for a, b in zip(every, every[1:], strict=False))


def test_unclear_suffixes_are_told_by_bounded_keys(spark, monkeypatch):
    rng = random.Random(2)
    block = [rng.randrange(4) for _ in range(60)]
    strings = [(k, block[rng.randrange(50):] + [rng.randrange(4) for _ in range(rng.randrange(20))]) for k in range(30)]
    strings += [(30, []), (31, [2]), (32, block), (33, block), (34, [3] * 50)]
    spans = [40, 50, 60, 30]
    df = staged(spark.createDataFrame([(s, t, [spans[x] for x in t]) for s, t in strings], STRING))

    def until(t, i, depth):
        out = []
        while i < len(t) and depth > 0:
            out, depth, i = [*out, t[i]], depth - spans[t[i]], i + 1
        return out

    calls, plain = [], suffix_array.suffix_ranks
    monkeypatch.setattr(suffix_array, "suffix_ranks", lambda *a: calls.append(1) or plain(*a))
    for most, levels in ((suffix_array.KEY_SYMBOLS, 0), (0, 1)):
        monkeypatch.setattr(suffix_array, "KEY_SYMBOLS", most)
        calls.clear()
        ranks = {r["s"]: r["ranks"] for r in plain(df, 400).collect()}
        every = sorted((ranks[s][i], until(t, i, 400)) for s, t in strings for i in range(len(t)))
        assert [k for _, k in every] == sorted(k for _, k in every)
        assert all(a[0] < b[0] or a[1] == b[1] for a, b in zip(every, every[1:], strict=False))
        # Keys of a few symbols need no further level.
        assert (len(calls) > 0) == (levels > 0)


@pytest.mark.parametrize("length", [40, 200])
def test_anchors_of_equal_windows_agree(length):
    rng = np.random.default_rng(0)
    passage = rng.integers(97, 101, length, np.uint8).tobytes()
    for _ in range(30):
        sides = [rng.integers(97, 101, rng.integers(0, 300), np.uint8).tobytes() for _ in range(4)]
        one, two = sides[0] + passage + sides[1], sides[2] + passage + sides[3]
        shared = np.intersect1d(byte_dedup.anchors(one, length), byte_dedup.anchors(two, length))
        for text, at in ((one, len(sides[0])), (two, len(sides[2]))):
            assert any(a <= at and at + length <= b for a, b in byte_dedup.passages(text, shared, length))
        assert byte_dedup.passages(one, np.zeros(0, np.uint64), length) == []


def test_query_over_the_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    spans = brute([r["text"] for r in rows], 200)
    found = {r["doc_id"]: r for r in QUERIES["op11_suffix_dedup"](spark, folder).collect()}
    assert len(found) == len(rows) and any(spans)
    for r, gone in zip(rows, spans, strict=True):
        f = found[r["doc_id"]]
        assert (f["n_bytes"], f["n_spans"], f["n_removed"]) == (len(r["text"].encode()), len(gone), sum(b - a for a, b in gone))
        assert f["kept_sha256"] == hashlib.sha256(kept(r["text"], gone)).hexdigest()


@pytest.mark.parametrize("length", [40, 200])
def test_texts_side_by_side_like_each_alone(monkeypatch, length):
    rng = np.random.default_rng(3)
    some = rng.integers(97, 101, length, np.uint8).tobytes()
    sizes = [0, 1, length - 1, length, length + 1, 3 * length, 900, 5, 2000, length]
    given = [rng.integers(97, 101, n, np.uint8).tobytes() for n in sizes] + [some, some, some + some, b"=" * 700, b""]
    alone = [byte_dedup.anchors(t, length) for t in given]
    # Every other gram, so that there are passages and bytes outside them.
    repeated = np.unique(np.concatenate(alone))[::2]
    for at_once in (1, 1000, 1 << 18):
        monkeypatch.setattr(byte_dedup, "BYTES_AT_ONCE", at_once)
        found, spans = [[] for _ in given], [[] for _ in given]
        for first, data, bounds in byte_dedup.side_by_side(pa.array([b"skipped", *given], pa.binary())[1:]):
            places, h = byte_dedup.anchors_beside(data, bounds, length)
            for k, x in zip(byte_dedup.own_text(bounds, places), h, strict=True):
                found[first + k].append(x)
            for a, b in byte_dedup.passages_beside(data, bounds, repeated, length):
                k = byte_dedup.own_text(bounds, np.array([a]))[0]
                assert b <= bounds[k + 1]
                spans[first + k].append((a - bounds[k], b - bounds[k]))
        assert [list(a) for a in alone] == found
        assert [byte_dedup.passages(t, repeated, length) for t in given] == spans and any(spans)


def test_ranges_that_touch_are_one():
    rng = random.Random(4)
    for n in (0, 1, 300):
        rows = [(rng.randrange(9), a := rng.randrange(200), a + rng.randrange(1, 12)) for _ in range(n)]
        row, start, end = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        index, first, last = byte_dedup.joined_spans(row, start, end)
        covered = {(r, x) for r, a, b in rows for x in range(a, b)}
        joined = list(zip(row[index].tolist(), first.tolist(), last.tolist(), strict=True))
        assert joined == sorted(joined) and covered == {(r, x) for r, a, b in joined for x in range(a, b)}
        assert all(p[0] < q[0] or p[2] < q[1] for p, q in zip(joined, joined[1:], strict=False))


def test_ranges_come_together_before_they_are_gathered(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text[::-1])], "doc_id int, text string")
    # A cut in about 48 bytes has a range of its own.
    found = {r["doc"]: r["spans"] for r in byte_dedup.removed_ranges(docs).collect()}
    assert sorted(found) == [1, 2] and all(len(spans) < 20 for spans in found.values())
    assert all(byte_dedup.joined_spans(*np.array([(0, *s) for s in spans]).T)[1:] == (0, 20_000) for spans in found.values())


def test_strings_over_many_batches(spark):
    rng = random.Random(6)
    strings = {k: [rng.randrange(50) for _ in range(n)] for k, n in enumerate([1, 30, 2, 200, 1, 7, 7, 90, 3])}
    rows = [(s, i, x, x % 5, x > 9) for s, t in strings.items() for i, x in enumerate(t)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "s bigint, i bigint, name bigint, span int, unclear boolean")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    plain = spark.conf.get(batch)
    try:
        for size in (1, 7, 10_000):
            spark.conf.set(batch, size)
            found = suffix_array.gathered(df, "unclear").collect()
            assert {r["s"]: r["names"] for r in found} == strings and len(found) == len(strings)
            assert all(r["spans"] == [x % 5 for x in r["names"]] and r["unclear"] == [x > 9 for x in r["names"]] for r in found)
    finally:
        spark.conf.set(batch, plain)
