"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is built from string and array functions of the engine. The gaps between matches (``split``) and the
matches (``regexp_extract_all``) alternate, so their lengths in code points add up to exact positions. Patterns use
possessive repetition where nothing that follows could need a shorter match: same matches, no deep recursion and no
quadratic search on long runs. A look behind keeps e-mail and IP searches from starting again inside a run that has
already failed as a whole.

Kinds email, ip, card and phone are the base: every match that passes its check is kept and counted. Three kinds are
added by the method: ``iban`` (mod-97 confirms it), ``ssn`` and ``secret`` (no checksum exists: a nearby context word is
needed). A secret is a run of 32 or more hexadecimal or base-64 characters that look random: letters and digits, and
an entropy of ``SECRET_BITS`` bits a character or more.
A score is a kind's prior, plus a bonus for a passed checksum, plus a bonus for a context word within
``CONTEXT_CHARS`` before or after; added kinds need ``min_score``.

Defined results: a null or empty text has no spans; repeated rows give equal rows; an empty table stays empty; extra
columns are left out. Spans may overlap between kinds, never within one.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import text_of

CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.25
CHECKSUM_BONUS = 0.4
MIN_SCORE = 0.6
SECRET_BITS = 3.0

LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn's checksum: from the right, every second digit counts double, less 9 when over 9."""
    places = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), lambda d: d.cast("int"))
    doubled = F.transform(places, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(code: Column) -> Column:
    """The checksum of IBANs: the first four characters moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.replace(code, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    value = lambda ch: F.instr(F.lit(LETTERS), ch) - 1
    step = lambda a, ch: (a * F.when(value(ch) > 9, 100).otherwise(10) + value(ch)) % 97
    return F.aggregate(F.split(moved, "(?!^)(?!$)"), F.lit(0), step) == 1


def _ip_parts(match: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, "\\."), small)


def _between(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(least, most)


def entropy(text: Column) -> Column:
    """Shannon's entropy of the characters of a text, in bits a character."""
    chars = F.split(text, "(?!^)(?!$)")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
    return -F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a + share(c) * F.log2(share(c)))


def _random(match: Column) -> Column:
    mixed = F.rlike(match, F.lit("[A-Za-z]")) & F.rlike(match, F.lit("[0-9](?:.*[0-9]){2}"))
    return F.when(mixed, entropy(match) >= SECRET_BITS).otherwise(F.lit(False))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    hint: Callable[[Column], Column]     # cheap test that every text with a match passes
    prior: float
    checked: bool                        # whether ``valid`` is a checksum
    context: str                         # words that make the kind likelier, as an alternation
    base: bool = True


KINDS = (
    Kind(
        "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True), lambda t: F.contains(t, F.lit("@")), 0.7, False, "e-?mail|contact|write|reach",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _ip_parts, lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]")), 0.5, False, "ip|host|server|address|addr",
    ),
    Kind(
        # Runs of fewer than 16 digits fail as a whole; a match of the longer ones starts where the run starts.
        "card", r"[0-9](?:[\x20-]?[0-9]){15,}+",
        lambda m: F.when(_between(16, 19)(m), luhn(_digits(m))).otherwise(F.lit(False)),
        lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")), 0.4, True, "card|visa|credit|debit|payment",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]",
        _between(8, 15), lambda t: F.contains(t, F.lit("+")), 0.5, False, "phone|tel|call|mobile|fax",
    ),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda m: F.when(F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34), mod97(m)).otherwise(F.lit(False)),
        lambda t: F.rlike(t, F.lit(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}")), 0.3, True, "iban|account|bank|transfer", False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda m: ~F.rlike(m, F.lit("^(?:000|666|9..)|-00-|0000$")),
        lambda t: F.rlike(t, F.lit("[0-9]-[0-9]{2}-[0-9]")), 0.4, False, "ssn|social security", False,
    ),
    Kind(
        "secret", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+={0,2}+(?![A-Za-z0-9+/=])",
        _random, lambda t: F.rlike(t, F.lit("[A-Za-z0-9+/]{32}")), 0.4, False,
        "tokens?|keys?|secrets?|passwords?|passwd|credentials?|bearer|auth|api", False,
    ),
)
SPAN = "array<struct<kind:string,start:int,end:int,score:double,value:string>>"


def _spans(text: Column, kind: Kind) -> Column:
    """All matches of a kind that pass its check, with positions in code points and scores."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pairs = F.zip_with(
        F.split(text, kind.pattern, -1), found, lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("value"))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(done: Column, pair: Column) -> Column:
        # The last gap has no match beside it.
        begin = done["at"] + pair["gap"]
        end = begin + F.coalesce(F.length(pair["value"]), F.lit(0))
        near = F.concat(
            F.substr(text, F.greatest(begin - CONTEXT_CHARS + 1, F.lit(1)), F.least(begin, F.lit(CONTEXT_CHARS))),
            F.lit(" "), F.substr(text, end + 1, F.lit(CONTEXT_CHARS)),
        )
        score = F.lit(kind.prior + CHECKSUM_BONUS * kind.checked) + F.when(
            F.rlike(F.lower(near), F.lit(rf"(?<![a-z])(?:{kind.context})(?![a-z])")), CONTEXT_BONUS
        ).otherwise(0.0)
        span = F.struct(
            F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"),
            F.round(F.least(score, F.lit(1.0)), 4).alias("score"), pair["value"].alias("value"),
        )
        kept = F.when(
            pair["value"].isNotNull() & F.coalesce(kind.valid(pair["value"]), F.lit(False)),
            F.concat(done["spans"], F.array(span).cast(SPAN)),
        ).otherwise(done["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    spans = F.aggregate(pairs, start, add, lambda done: done["spans"])
    return F.when(kind.hint(text), spans).otherwise(F.array().cast(SPAN))


def find(docs: DataFrame, min_score: float = MIN_SCORE, key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``spans``: array of (kind, start, end, score, value), by kind as listed, then by start."""
    whole = docs.select(F.col(key).alias("doc_id"), text_of().alias("text"))
    by_kind = whole.select("doc_id", *[_spans(F.col("text"), k).alias(k.name) for k in KINDS])
    kept = [
        F.col(k.name) if k.base else F.filter(F.col(k.name), lambda s: s["score"] >= min_score) for k in KINDS
    ]
    return by_kind.select("doc_id", F.concat(*kept).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced together."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done: Column, s: Column) -> Column:
        gap = F.substr(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        mark = F.when(s["start"] >= done["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], gap, mark).alias("out"))

    return F.aggregate(ordered, start, add, lambda d: F.concat(d["out"], F.substr(text, d["at"] + 1)))
