"""Groups against all pairs compared one by one."""

import random
import re

import numpy as np
import pytest

from kempt.llm import jaccard_join as jj
from kempt.llm.components import components
from kempt.llm.queries import QUERIES
from kempt.operators.staging import collecting, release


def brute_set(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1)))


def brute(docs):
    sets = [(k, brute_set(t)) for k, t in docs]
    leader = {k: k for k, _ in docs}

    def root(k):
        while leader[k] != k:
            k = leader[k]
        return k

    filled = [(k, s) for k, s in sets if s and k is not None]
    for i, (k, s) in enumerate(filled):
        for m, t in filled[:i]:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                a, b = sorted((root(k), root(m)))
                leader[b] = a
    return sorted((k, len(s), None if k is None else root(k)) for k, s in sets if k is not None)


def ours(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jj.groups(df).collect() if r["doc_id"] is not None)


def family(rng, start, size, words, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    for k in range(size):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
        yield start + k, " ".join(own)


def test_like_all_pairs(spark):
    rng = random.Random(8)
    docs = [(0, None), (1, ""), (2, " \n"), (3, "a b"), (4, "A  B"), (5, "a b c"), (6, "a\xa0b"), (7, "É a b c d"), (8, "é a b c d")]
    for f, (words, edits) in enumerate([(6, 1), (9, 1), (14, 1), (30, 2), (60, 3), (60, 5), (200, 9), (700, 30), (1500, 80)]):
        docs += family(rng, 100 * (f + 1), 14, words, edits)
    line = "this line stands in very many of the documents here"
    docs += [(2000 + i, line + " " + " ".join(f"y{rng.randrange(9_000)}" for _ in range(rng.choice([2, 3, 25, 60])))) for i in range(80)]
    docs += [(3000 + i, docs[130][1]) for i in range(30)]
    df = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id bigint, text string, n int, sig string")
    expected = brute(docs)
    assert ours(df) == expected
    kept = jj.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, _, c in expected if k == c]


def test_large_families_by_blocks(spark, monkeypatch):
    """With tiny limits every open group goes by blocks; families hold several components."""
    monkeypatch.setattr(jj, "GROUP", 2)
    monkeypatch.setattr(jj, "BLOCK_NODES", 5)
    rng = random.Random(4)
    docs = [d for f in range(3) for d in family(rng, 100 * f, 40, 40 + 90 * f, 4 + 8 * f)]
    # A long text and a shorter one whose histograms have different numbers of ranges.
    docs += [(900, " ".join(f"v{i}" for i in range(102))), (901, " ".join(f"v{i}" for i in range(80))), (902, " ".join(f"v{i}" for i in range(20, 102)))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert ours(df) == brute(docs)


@pytest.mark.parametrize("seed", range(3))
def test_linking_sets_share_a_signature(seed):
    rng = np.random.default_rng(seed)
    common = np.sort(rng.integers(0, 1 << 63, 20, dtype=np.uint64))
    for _ in range(400):
        n = int(rng.integers(1, 300))
        base = np.unique(np.concatenate([rng.integers(0, 1 << 63, n, dtype=np.uint64), common[:rng.integers(0, 21)]]))
        drop, add = rng.integers(0, len(base) // 6 + 1), rng.integers(0, len(base) // 6 + 1)
        other = np.unique(np.concatenate([rng.permutation(base)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
        if len(other) and jj.similar(base, other):
            assert set(jj.signatures(base, common).tolist()) & set(jj.signatures(other, common).tolist())
            sizes = (len(base), len(other))
            assert jj.may_link(jj.histogram(base).tobytes(), jj.histogram(other).tobytes(), sizes)


def test_repeated_keys_and_null_keys(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(5, text), (5, "other words of the same key here"), (7, "other words of the same key here"), (9, text), (9, text), (None, text)]
    rows = jj.groups(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows if r["doc_id"]) == [(5, 5), (5, 5), (7, 5), (9, 5), (9, 5)]
    assert [(r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is None] == [(26, None)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert jj.groups(df).collect() == [] and jj.one_per_group(df).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(40, 30), (41, 30), (41, 42), (50, 50)]
    rows = components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    expected = {i: 0 for i in range(21)} | {i: 30 for i in (30, 40, 41, 42)}
    assert {r["node"]: r["component"] for r in rows} == expected and len(rows) == len(expected)


def test_query_over_the_whole_table(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = QUERIES["op10_jaccard_join"](spark, folder).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == brute(docs)


def passages(rng, count, passage, own):
    """Texts of own words around one of a few passages: they share signatures, but do not link."""
    shared = [" ".join(f"p{j}x{i}" for i in range(passage)) for j in range(3)]
    return [(i, f"{shared[i % 3]} " + " ".join(f"o{rng.randrange(10**9)}" for _ in range(own))) for i in range(count)]


def test_passages_of_few_texts_of_a_block_are_common(spark):
    """A passage in 3 of 400 texts comes last in their orders, so these texts do not meet."""
    rng = random.Random(2)
    docs = passages(rng, 9, 20, 60) + [(100 + i, " ".join(f"o{rng.randrange(10**9)}" for _ in range(70))) for i in range(391)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    common = jj._common(jj._measured(df, "bigint"))
    assert set(jj.shingles(docs[0][1])) & set(jj.shingles(docs[3][1])) <= set(common.tolist())
    sets = [jj.signatures(jj.shingles(t), common).tolist() for _, t in docs]
    assert len({s for one in sets for s in one}) == sum(map(len, sets))


@pytest.mark.parametrize("size", [1, 40, 127, 128, 400, 3_000, 300_000])
def test_histograms_are_small_and_bound_the_difference(size):
    rng = np.random.default_rng(size)
    base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1))
    assert 8 * len(jj.histogram(base)) <= max(64, 2.5 * size)
    for cut in (0, size // 9, size // 3, size):
        other = np.unique(np.concatenate([base[cut:], rng.integers(0, 1 << 63, cut // 8 + 1, dtype=np.uint64)]))
        one, two = jj.histogram(base), jj.histogram(other)
        least = min(len(one), len(two))
        odd = int(np.bitwise_count(jj._coarser(one, least) ^ jj._coarser(two, least)).sum())
        assert odd <= len(np.setxor1d(base, other))
        assert jj.may_link(one.tobytes(), two.tobytes(), (len(base), len(other))) or not jj.similar(base, other)


def test_histograms_tell_unlike_sets_apart():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64) << np.uint64(1)) for _ in range(40)]
    hists = [jj.histogram(s).tobytes() for s in sets]
    assert not [1 for i in range(40) for j in range(i) if jj.may_link(hists[i], hists[j], (len(sets[i]), len(sets[j])))]


def test_steps_are_released(spark):
    """What a step has stored on the way goes; only what the result reads stays."""
    rng = random.Random(3)
    docs = [d for f in range(3) for d in family(rng, 100 * f, 8, 40, 3)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    with collecting() as left:
        assert ours(df) == brute(docs)
    labels = {path.rpartition("/")[2].split("-")[0] for path in left}
    release(spark, left)
    assert not labels & {"links", "possible", "wanted", "sets", "apart", "families"}
