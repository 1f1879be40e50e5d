"""Runs, the strongest run and collapsed texts against a plain search over all lags."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kempt.llm import periodic
from kempt.llm.queries import QUERIES


def brute(words, min_words=24, min_copies=3):
    """Every lag, every unbroken line of matches; a stretch that a smaller period fills as well is no run of this one."""
    n, found = len(words), {}
    for q in range(1, n // min_copies + 1):
        i = q
        while i < n:
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            length = i - first + q
            if i > first and length >= max(min_words, min_copies * q):
                found.setdefault((first - q, length), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in found.items())


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[:-q] or q == len(words))


def random_words(rng):
    """Nested repetitions of a few words with some noise."""
    words = [rng.choice("abc") for _ in range(rng.randrange(1, 6))]
    while len(words) < rng.randrange(5, 160):
        step = rng.randrange(4)
        if step == 0:
            words = words * rng.randrange(2, 6)
        elif step == 1:
            words += [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]
        elif step == 2:
            words += words[-rng.randrange(1, 12):] * rng.randrange(2, 9)
        else:
            words[rng.randrange(len(words))] = rng.choice("abx")
    return words[:400]


@pytest.mark.parametrize("least, copies", [(24, 3), (3, 3), (6, 3), (12, 4), (9, 5)])
def test_like_a_plain_search(least, copies):
    rng = random.Random(least * copies)
    some = 0
    for _ in range(150):
        words = random_words(rng)
        ids = periodic.numbered([w.encode() for w in words])
        runs = periodic.runs_of(ids, least, copies)
        assert runs == brute(words, least, copies)
        assert all(smallest_period(words[s:s + n]) == q for s, n, q in runs)
        some += len(runs)
    assert some > 100


def test_long_texts_take_no_quadratic_time():
    same = np.zeros(300_000, np.int64)
    assert periodic.runs_of(same) == [(0, 300_000, 1)]
    line = np.tile(np.arange(17), 20_000)
    assert periodic.runs_of(line) == [(0, 340_000, 17)]
    large = np.tile(np.random.default_rng(0).integers(0, 90, 50_000), 3)
    assert periodic.runs_of(large) == [(0, 150_000, 50_000)]


def test_odd_rows(spark):
    line = "one two\tthree\n" * 9
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, line), (4, line), (None, line), (5, "é😀 " * 40), (6, "a b c " * 30)]
    df = spark.createDataFrame([(k, t, "own", 5) for k, t in docs], "doc_id bigint, text string, collapsed string, runs int")
    rows = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find(df).collect()]
    assert sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)) == [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 27, [(0, 27, 3)], "one two three"),
        (4, 27, [(0, 27, 3)], "one two three"), (5, 40, [(0, 40, 1)], "é😀"), (6, 30, [(0, 30, 1)], "a b c"),
        (None, 27, [(0, 27, 3)], "one two three"),
    ]


def test_empty_table_and_wrong_limits(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert periodic.find(empty).collect() == []
    with pytest.raises(ValueError):
        periodic.find(empty, min_copies=2)


def test_strongest_run_of_ties(spark):
    runs = [[(5, 30, 10), (40, 9, 3), (60, 27, 9)], [(0, 31, 10), (9, 30, 10)], []]
    df = spark.createDataFrame([(r,) for r in runs], f"runs array<{periodic.RUN}>").select(periodic.strongest(F.col("runs")).alias("r"))
    assert [tuple(r["r"]) if r["r"] else None for r in df.collect()] == [(5, 30, 10), (0, 31, 10), None]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_over_the_whole_table(spark, folder):
    found = {r["doc_id"]: r for r in QUERIES["op13_periodic"](spark, folder).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert found.keys() == docs.keys()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    some = 0
    for k, text in docs.items():
        words = planted(k, [w.decode() for w in (text or "").encode().split()])
        runs, r = brute(words), found[k]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
        some += bool(runs)
    assert some > 5
