"""Quality rules whose cutoffs are chosen so that few clean documents can be lost.

Base measures of a text are counted exactly over its whole length. Each rule compares a ratio of them with a cutoff.
Cutoffs are not set by hand: labelled clean documents (quality 1) are a holdout on which sets of cutoffs are judged, per
stratum, by an exact binomial (Clopper-Pearson) upper bound on the share of clean documents that the whole set rejects.
The sets form one sequence that is the same for all tables, from loosest to strictest, each one tightening
one rule of the set before: first the ``GROSS`` loosest cutoffs of every rule, then rule by rule to its strictest. A
stratum walks it until the first set whose bound at ``error`` / strata exceeds ``loss``. No set behind a failed one is
used, so the sets of a stratum need no further division of the error: all rules together reject at most ``loss`` of
each stratum's clean documents with probability 1 - ``error``. Of the certified sets the one that rejects most bad (label
0) over clean documents is used, without rules that reject no bad one; where labels are too few (with the defaults,
under 217 clean ones), or no bad one would go, all rules stay off in that stratum. Strata are bands of the word count, a fixed number whatever the data.

Measuring streams through ``mapInArrow``; what reaches the driver is one row of counts per stratum and set.

Defined results: a null or empty text has no words, fails the base rule and is not kept; a document with conflicting
labels counts with the lowest; null labels are left out; repeated rows give equal rows; an empty table stays empty;
extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, staged

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
STRATA = (100, 250, 1000)       # word counts that part the strata
LOSS = 0.02
ERROR = 0.05
GROSS = 2                       # so many cutoffs of each rule come before any rule's stricter ones

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    name: str
    value: Column
    cutoffs: tuple[float, ...]   # a value above the cutoff is rejected


def _ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> tuple[Rule, ...]:
    shares = (0.005, 0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)
    return (
        Rule("symbols", _ratio("n_symbols", "word_chars"), shares),
        Rule("dup_lines", _ratio("n_dup_lines", "n_lines"), shares),
        Rule("repeats", _ratio("n_repeat_words", "n_words"), shares),
        Rule("long_words", _ratio("word_chars", "n_words"), (6, 7, 8, 9, 10, 12, 15, 20, 30)),
        Rule("short_words", -_ratio("word_chars", "n_words"), (-5, -4.5, -4, -3.5, -3, -2.5, -2, -1.5)),
    )


def measure_text(text: str) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    words = text.encode("utf-8", "surrogatepass").split()      # bytes split at exactly these six white spaces
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    blanks = sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), _repeated(words), len(lines)


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n = len(number)
    if n >= 1 << 20:
        # Three numbers would not fit into one: number the pairs first.
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        codes = pairs[:-1] * n + ids[2:]
    else:
        codes = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    ordered = np.sort(codes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(codes, twice))
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[at + k] = True
    return int(covered.sum())


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure_text(t.as_py() or "") for t in batch.column("text")]
            columns = zip(*rows, strict=True) if rows else [()] * len(MEASURES)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                **{name: pa.array(values, pa.int64()) for name, values in zip(MEASURES, columns, strict=True)},
            })

    schema = f"doc_id {kind}, " + ", ".join(f"{name} bigint" for name in MEASURES)
    return map_texts(docs.select("doc_id", F.col("text")), schema, work)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum(bands: Sequence[int]) -> Column:
    return reduce(lambda total, edge: total + (F.col("n_words") >= edge).cast("int"), bands, F.lit(0))


def upper_bound(rejected: int, clean: int, error: float) -> float:
    """Clopper-Pearson: the share p at which ``rejected`` or fewer of ``clean`` have probability ``error``."""
    if rejected >= clean:
        return 1.0

    def at_most(p: float) -> float:
        terms = [
            math.lgamma(clean + 1) - math.lgamma(k + 1) - math.lgamma(clean - k + 1)
            + k * math.log(p) + (clean - k) * math.log1p(-p)
            for k in range(rejected + 1)
        ]
        top = max(terms)
        return math.exp(top) * math.fsum(math.exp(t - top) for t in terms) if top > -700 else 0.0

    low, high = rejected / clean, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if 0 < middle < 1 and at_most(middle) > error:
            low = middle
        else:
            high = middle
    return high


def sequence(every: Sequence[Rule]) -> list[tuple[Rule, float]]:
    """The steps of the walk: each sets one rule's cutoff and leaves the others where they are."""
    # Prose seldom holds symbols or extreme words; clean lists, forms and songs do repeat themselves, so they come last.
    order = ("symbols", "long_words", "short_words", "repeats", "dup_lines")
    loose = [(r, sorted(r.cutoffs, reverse=True)) for r in sorted(every, key=lambda r: order.index(r.name))]
    return [(r, c) for part in (slice(GROSS), slice(GROSS, None)) for r, cutoffs in loose for c in cutoffs[part]]


def certify(
    measured: DataFrame, labels: DataFrame, bands: Sequence[int] = STRATA, loss: float = LOSS, error: float = ERROR
) -> dict[tuple[int, str], float]:
    """The certified cutoff of each (stratum, rule); a pair without one is missing."""
    judged = measured.where(~base_failed()).join(
        labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality is not null"), "doc_id"
    )
    every = rules()
    steps = sequence(every)
    good = F.col("quality") == 1
    # Sets are nested: a document goes at the first step that any rule rejects it at, and from then on.
    first = {
        r.name: F.least(*[F.when(r.value > c, at).otherwise(len(steps)) for at, (s, c) in enumerate(steps) if s.name == r.name])
        for r in every
    }
    counts = judged.select(stratum(bands).alias("stratum"), good.alias("good"), *[c.alias(n) for n, c in first.items()])
    rows = counts.groupBy("stratum", F.least(*first).alias("step")).agg(
        F.count_if("good").alias("clean"), F.count_if(~F.col("good")).alias("bad"),
        *[F.min(F.when(~F.col("good"), F.col(n))).alias(n) for n in first],
    ).collect()
    chosen = {}
    for level in sorted({r["stratum"] for r in rows}):
        own = {r["step"]: r for r in rows if r["stratum"] == level}
        allowed = _most_allowed(sum(r["clean"] for r in own.values()), loss, error / (len(bands) + 1))
        clean = bad = gain = 0
        best = -1
        for at in range(len(steps)):
            if at in own:
                clean, bad = clean + own[at]["clean"], bad + own[at]["bad"]
            if clean > allowed:
                break
            # Of equals, the loosest.
            if bad - clean > gain:
                best, gain = at, bad - clean
        needed = {r.name for r in every if any(x[r.name] is not None and x[r.name] <= best for x in own.values())}
        chosen |= {(level, r.name): float(c) for r, c in steps[:best + 1] if r.name in needed}
    return chosen


def _most_allowed(clean: int, share: float, error: float) -> int:
    """The largest count whose upper bound is within ``share``; -1 if not even none is."""
    low, high = -1, int(clean * share) + 1
    while low + 1 < high:
        middle = (low + high) // 2
        low, high = (middle, high) if upper_bound(middle, clean, error) <= share else (low, middle)
    return low if low >= 0 or upper_bound(0, clean, error) > share else 0


def judge(
    docs: DataFrame, labels: DataFrame, bands: Sequence[int] = STRATA, loss: float = LOSS, error: float = ERROR
) -> DataFrame:
    """``doc_id``, the measures, ``stratum``, ``base_failed``, ``failed`` (names of failed rules) and ``kept``."""
    measured = staged(measure(docs), "measures")
    chosen = certify(measured, labels, bands, loss, error)
    failed = []
    for r in rules():
        cutoffs = [(s, c) for (s, name), c in sorted(chosen.items()) if name == r.name]
        broken = reduce(
            lambda found, sc: found | ((F.col("stratum") == sc[0]) & (r.value > sc[1])), cutoffs, F.lit(False)
        )
        failed.append(F.when(broken, F.lit(r.name)))
    judged = measured.withColumns({"base_failed": base_failed(), "stratum": stratum(bands)})
    return judged.withColumn("failed", F.array_compact(F.array(*failed))).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)
    )
