"""Ids and decoded texts against the public tokenizers library."""

import hashlib
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kempt.llm import bpe
from kempt.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    None, "", " ", "  a  b \n c\t\td  ", "it's WE'LL don't 12 345,6 ½²x", "<|endoftext|>a<|endoftext|> <|endoftext|",
    "é😀 ñandú ¿qué? 中文字 العربية  x  y \x1c z\x85", "###$$$ &&&%%%", "a" * 3000, "ab" * 500 + " " * 300 + "x",
    "word " * 2000, "𝔘nicode " * 20, "line\n\nline\r\n  line",
]


def ours(texts):
    v = bpe.vocabulary(PATH)
    return [[int(i) for e in row for i in e[0].split(b",") if i] for row in v.encode(texts)]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_like_the_library(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in bpe.encode(df, PATH).collect()}
    for i, text in enumerate(TEXTS):
        ids = library(text or "")
        assert rows[i]["ids"] == ids and bpe.decode(ids, PATH) == LIBRARY.decode(ids, skip_special_tokens=False)
        assert rows[i]["decoded"] == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'abcdest,.é0")), max_size=60))
def test_any_text(text):
    assert ours([text]) == [library(text)]


@given(st.binary(min_size=1, max_size=32))
def test_rows_and_single_pieces_agree(piece):
    v = bpe.vocabulary(PATH)
    assert v.merge_rows([piece], 32)[1].tolist() == v.merge_long(piece)


def test_ids_that_split_a_character_decode_to_replacements():
    ids = library("😀")[:1]
    assert bpe.decode(ids, PATH) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_a_huge_word_takes_little_time():
    start = time.time()
    assert ours(["xyzzy" * 20_000])[0] == library("xyzzy" * 20_000)
    assert time.time() - start < 20


def test_query_over_the_whole_table(spark, folder):
    given_rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op4_bpe"](spark, folder).collect()
    assert len(rows) == len(given_rows)
    for r in rows:
        ids = library(given_rows[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, ids int, n_tokens string")
    assert bpe.encode(df, PATH).collect() == [] and bpe.digests(df, PATH).collect() == []


@pytest.mark.parametrize("kind", ["int", "string"])
def test_other_key_types(spark, kind):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
    assert bpe.digests(df, PATH).first()["n_tokens"] == 2


def test_each_piece_is_merged_once_and_recent_words_stay(monkeypatch):
    vocab = bpe.Vocabulary(PATH)
    merged, plain = [], vocab.merge
    monkeypatch.setattr(vocab, "merge", lambda pieces: merged.append(pieces) or plain(pieces))
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    texts = ["the word, the word. the word! 12 word", "", "éè, éè. x² 12"]
    rows = [list(row) for row in vocab.encode(texts)]
    assert [b"".join(e[2] for e in row).decode() for row in rows] == texts
    assert all(len(set(pieces)) == len(pieces) for pieces in merged)
    known = len(vocab.known)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    for _ in vocab.encode([" ".join(f"w{i}" for i in range(30)), "the end"]):
        pass
    assert known == 0 and len(vocab.known) == 0
    for text in ("a b c d e f g h i j k l", " m n o p q r s t u v", "the end"):
        list(vocab.encode([text]))
    assert " m" in vocab.known and "the" in vocab.known
