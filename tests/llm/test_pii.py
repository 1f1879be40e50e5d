"""Spans against Python's own regular expressions, checksums against textbook values."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from kempt.llm import pii
from kempt.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def brute(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in BASE.items() for m in re.finditer(pattern, text or "") if valid(kind, m.group())
    ]


TEXTS = [
    None, "", "nothing here", "mail a.b@c.d_e@f.gh, x@y, @z.q, é😀 me+you@site-1.co.uk.", "1.2.3.4.5.6.7.8 and 999.1.1.1 007.0.0.0255",
    "card 4417744280351547 or 4417 7442 8035 1547-1 and 4417-7442-8035-1547", "+49 (30) 1234-5678. +1 2 +(3) +1234567 8",
    "a" * 3_000 + "@" + "b" * 3_000, "1" * 4_000, "1-" * 20_000, "+1 " + "(" * 20_000, "x@" * 5_000 + "x.y",
    "\n".join(f"u{i}@h{i}.org +1 555 000 {i:04d} 10.0.{i % 300}.1" for i in range(300)),
]


def test_base_spans_like_plain_regular_expressions(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").withColumn("spans", F.lit(1))
    rows = {r["doc_id"]: r["spans"] for r in pii.find(df).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        base = [f"{s['kind']}:{s['start']}:{s['end']}" for s in rows[i] if s["kind"] in BASE]
        assert base == brute(text)
        assert all((text or "")[s["start"]:s["end"]] == s["value"] for s in rows[i])


def test_query_over_the_whole_table(spark, folder):
    given = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_pii"](spark, folder).collect()
    assert len(rows) == len(given)
    for r in rows:
        expected = brute(given[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(e.startswith(k + ":") for e in expected) for k in BASE]


@pytest.mark.parametrize("code, good", [
    ("DE89370400440532013000", True), ("GB82 WEST 1234 5698 7654 32", True), ("DE89370400440532013001", False),
])
def test_iban_needs_its_checksum(spark, code, good):
    df = spark.createDataFrame([(1, f"pay to {code} today")], "doc_id bigint, text string")
    spans = [s for s in pii.find(df).first()["spans"] if s["kind"] == "iban"]
    assert [s["value"] for s in spans] == ([code] if good else [])


def test_context_raises_the_score(spark):
    df = spark.createDataFrame([(1, "my ssn is 123-45-6789"), (2, "part no 123-45-6789")], "doc_id bigint, text string")
    rows = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find(df).collect()}
    assert rows == {1: ["ssn"], 2: []}


def iban_ok(code):
    plain = code.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def bits(text):
    return -sum(text.count(c) / len(text) * math.log2(text.count(c) / len(text)) for c in set(text))


def added(text):
    """The spans of the added kinds, by plain expressions; ssn and secret need a context word within 40 characters."""
    near = lambda m, words: re.search(
        rf"(?<![a-z])(?:{words})(?![a-z])", (text[max(m.start() - 40, 0):m.start()] + " " + text[m.end():m.end() + 40]).lower())
    out = []
    for m in re.finditer(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", text):
        if iban_ok(m.group()):
            out.append(f"iban:{m.start()}:{m.end()}")
    for m in re.finditer(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", text):
        if near(m, "ssn|social security"):
            out.append(f"ssn:{m.start()}:{m.end()}")
    for m in re.finditer(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+={0,2}+(?![A-Za-z0-9+/=])", text):
        own = m.group()
        if re.search("[A-Za-z]", own) and len(re.findall("[0-9]", own)) >= 3 and bits(own) >= 3 and near(
            m, "tokens?|keys?|secrets?|passwords?|passwd|credentials?|bearer|auth|api"
        ):
            out.append(f"secret:{m.start()}:{m.end()}")
    return out


def test_added_kinds_like_plain_expressions(spark):
    rng = random.Random(5)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    pieces = lambda: rng.choice([
        "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013001", "ssn", "123-45-6789", "000-12-3456",
        "social security no", "token = ", f'"{hexes(40)}"', hexes(31), hexes(64), "a" * 40, "0" * 40, "api_key:", "bearer",
        "é😀 word", "some words that keep things apart, forty or more", "QUJD" * 5 + "0123456789abcdefXYZ+/==", "monkeys", ".",
    ])
    given = [" ".join(pieces() for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    found = pii.find(spark.createDataFrame(list(enumerate(given)), "doc_id bigint, text string")).collect()
    kinds = set()
    for r in found:
        own = [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["kind"] in ("iban", "ssn", "secret")]
        assert own == added(given[r["doc_id"]])
        kinds |= {x.split(":")[0] for x in own}
    assert kinds == {"iban", "ssn", "secret"}


def test_planted_tokens_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {
        (r["doc_id"], m.start(1), m.end(1)) for r in docs.collect() for m in re.finditer('token = "([0-9a-f]{40})"', r["text"])
    }
    found = {
        (r["doc_id"], s["start"], s["end"]) for r in pii.find(docs).collect() for s in r["spans"] if s["kind"] == "secret"
    }
    assert len(planted) == 13 and found == planted


def test_redact(spark):
    df = spark.createDataFrame([(1, "write to é@b.c? a@b.org, or +49 30 12345678!")], "doc_id bigint, text string")
    joined = df.join(pii.find(df), "doc_id").select(pii.redact(F.col("text"), F.col("spans")).alias("t"))
    assert joined.first()["t"] == "write to é@b.c? [email], or [phone]!"


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_plan_is_native(spark, folder, capsys):
    QUERIES["op5_pii"](spark, folder).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan
