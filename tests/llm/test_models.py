"""Language and quality models: accuracy on held-out rows, and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kempt.llm import language, quality_model
from kempt.llm.queries import QUERIES, remainder

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    given = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_language"](spark, SF).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == given[r["doc_id"]][0] for r in held) > 0.97 * len(held)
    assert sum(r["rejected"] for r in rows) <= 0.005 * len(rows)


def test_odd_texts_have_no_language(spark):
    docs = [(i, t, "en", 1) for i, t in enumerate(["the and of this", "this of the day", "and that one"] * 20)]
    docs += [(100 + i, t, "fr", 1) for i, t in enumerate(["le la les une", "une des les est", "est dans le mur"] * 20)]
    odd = [(900, None, "en", 1), (901, "", None, 1), (902, "12 34 !?", "fr", 1), (903, "ça est une des", None, 1)]
    df = spark.createDataFrame(docs + odd, "doc_id bigint, text string, lang string, score int")
    model = language.fit(df, F.lit(True))
    rows = {r["doc_id"]: r for r in language.identify(df, model).collect()}
    assert all(rows[i]["lang_pred"] == lang for i, _, lang, _ in docs)
    assert [rows[i]["lang_pred"] for i in (900, 901, 902, 903)] == ["und", "und", "und", "fr"]
    kept = language.keep_identified(df, model)
    assert kept.columns == df.columns and not {900, 901, 902} & {r["doc_id"] for r in kept.collect()}


def test_any_number_of_languages(spark):
    rng = np.random.default_rng(0)
    words = {k: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(4)] for k in range(230)}
    docs = [(10 * k + i, " ".join(rng.permutation(words[k] * 3)), f"l{k}") for k in words for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    model = language.fit(df, F.lit(True))
    assert len(model.languages) == 230
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, model).collect()}
    assert sum(found[k] == lang for k, _, lang in docs) > 0.99 * len(docs)
    with pytest.raises(ValueError, match="over 200"):
        language.fit(df, F.lit(True), most_labels=200)


def test_far_texts_are_rejected(spark):
    docs = [(i, f"the day and the night of this {i} year", "en") for i in range(60)]
    df = spark.createDataFrame([*docs, (99, "жщъ юяэ ыъь ъъ", None)], "doc_id bigint, text string, lang string")
    model = language.fit(df, F.lit(True))
    rejected = {r["doc_id"] for r in language.identify(df, model).where("rejected").collect()}
    assert rejected == {99}


def test_no_labels_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, quality int")
    some = spark.createDataFrame([(1, "text", None, None)], empty.schema)
    assert language.fit(some, F.lit(True)) is None
    assert language.identify(some, None).first()["lang_pred"] == "und"
    assert language.identify(empty, None).collect() == []
    weights = quality_model.fit(some, some.select("doc_id", "quality"), F.lit(True))
    assert quality_model.score(some, weights).first()["score"] == 0.5
    assert quality_model.score(empty, weights).collect() == []


def test_quality_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op3_quality_model"](spark, SF).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) > 0.98 * len(held)


def test_ftrl_learns_a_separable_rule():
    leader = quality_model.Ftrl()
    good, bad = quality_model.features("calm clear words"), quality_model.features("buy### now### win###")
    for _ in range(40):
        leader.learn(*good, 1)
        leader.learn(*bad, 0)
    assert leader.weights(good[0]) @ good[1] > 1 and leader.weights(bad[0]) @ bad[1] < -1


@pytest.mark.parametrize("text", ["", "one", "a a a a", "é😀 \ud800".replace("\ud800", ""), "x " * 1000])
def test_features(text):
    places, values = quality_model.features(text)
    assert places[0] == 0 and len(set(places.tolist())) == len(places)
    assert np.isclose(np.linalg.norm(values[1:]), quality_model.LENGTH if len(places) > 1 else 0)


def test_remainder_of_a_null_key(spark):
    df = spark.createDataFrame([(None,), (5,)], "doc_id bigint").select(remainder(3).alias("r"))
    assert [r["r"] for r in df.collect()] == [0, zlib.crc32(b"5") % 3]
