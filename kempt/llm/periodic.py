"""Periodic run detection: stretches of words in which a short block repeats, found along the diagonals of a text.

A run is a stretch with smallest period q (words q apart are equal) of at least ``min_words`` words and ``min_copies``
periods that no neighbouring word extends. On the diagonal of lag q, the pairs (i - q, i) of equal words, it is one
unbroken line of matches.

Method: an online sparse dynamic program over the diagonals. It walks along the words; the earlier occurrences of the
words at a place increment the match lengths of their lags, a lag that is not incremented ends, and if its line is long
enough, its run is emitted at once. It is sparse, since a place asks for earlier occurrences of whole grams of
2^k words, and for each k only for the latest one, at a lag over 2^(k-1) and up to 2^k. That finds all runs and no others:

* inside a run of smallest period q, a gram of q words or more returns after exactly q words and not before (two periods
  over so long a stretch have their greatest common divisor as a period too), so all places of a run name its lag;
* a run is longer than a gram plus q, so at least one place names it; the lowest k has lags from 1 on;
* a line whose latest gram is at lag q has no smaller period, so multiples of a period are never followed.

So a text of n words costs O(n log n), whatever it holds. Grams are named exactly, by pairs of names of half
the length. Each row is one task's work for a moment only; nothing is shuffled and nothing depends on other rows.

Defined results: a null text has no words; words are parted by blanks, tabs and line ends (ASCII); repeated rows give
equal rows; an empty table stays empty; other columns, whatever their names, are left out; a null key is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_texts

MIN_WORDS = 24
MIN_COPIES = 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text. ``bytes.split`` parts at the six ASCII blanks only."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Names of grams of twice the ``width``: equal exactly where both halves are."""
    pairs = names[:-width] * (names.max() + 1) + names[width:]
    return np.unique(pairs, return_inverse=True)[1]


def latest_lags(names: np.ndarray) -> np.ndarray:
    """How far back each gram last occurred; 0 if it is new."""
    order = np.argsort(names, kind="stable")
    again = names[order[1:]] == names[order[:-1]]
    lags = np.zeros(len(names), np.int64)
    lags[order[1:][again]] = (order[1:] - order[:-1])[again]
    return lags


def matches(ids: np.ndarray, min_words: int, min_copies: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``place, lag, width``, by place: a gram of ``width`` words at ``place`` last occurred ``lag`` words before."""
    lowest = 1 << (min_words * (min_copies - 1) // min_copies).bit_length() - 1
    found, names, width = [], ids, 1
    # A longer gram has room only while some period over half its width fits the text often enough.
    while width <= lowest or min_copies * (width // 2) < len(ids):
        if width >= lowest:
            lags = latest_lags(names)
            if not lags.any():
                break
            least = 0 if width == lowest else width // 2
            places = np.flatnonzero((lags > least) & (lags <= width))
            found.append(np.stack([places, lags[places], np.full(len(places), width)]))
        if len(names) <= width:
            break
        names, width = doubled(names, width), 2 * width
    every = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    return tuple(every[:, np.argsort(every[0], kind="stable")])


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_copies: int = MIN_COPIES) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start and period."""
    if min_copies < 3 or min_words < min_copies:
        raise ValueError("a run has at least three copies of its period and as many words")
    if len(ids) < min_words:
        return []
    runs: list[tuple[int, int, int]] = []
    active: dict[int, list[int]] = {}       # lag -> first place of its line, last place, words behind the last place

    def close(lag: int) -> None:
        first, last, width = active.pop(lag)
        length = last + width - first + lag
        if length >= max(min_words, min_copies * lag):
            runs.append((first - lag, length, lag))

    now = -1
    for place, lag, width in zip(*(x.tolist() for x in matches(ids, min_words, min_copies)), strict=True):
        if place != now:
            now = place
            for ended in [k for k, (_, last, _) in active.items() if last < place - 1]:
                close(ended)
        line = active.get(lag)
        if line is None:
            active[lag] = [place, place, width]
        else:
            line[1] = place
    for lag in list(active):
        close(lag)
    return sorted(runs)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds behind its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    covered = np.cumsum(edges[:-1]) > 0
    return [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]


def find(docs: DataFrame, min_words: int = MIN_WORDS, min_copies: int = MIN_COPIES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every whole text: its runs by start and period, and its words, joined by
    one blank, without the repetitions."""
    if min_copies < 3 or min_words < min_copies:
        raise ValueError("a run has at least three copies of its period and as many words")
    kind = docs.schema["doc_id"].dataType.simpleString()
    layout = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, texts = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                runs = runs_of(numbered(words), min_words, min_copies)
                sizes.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass"))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(sizes, pa.int64()),
                "runs": pa.array(found, layout), "collapsed": pa.array(texts, pa.string()),
            })

    schema = f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string"
    return map_texts(docs.select("doc_id", F.col("text")), schema, work)


def strongest(runs: Column) -> Column:
    """The run with most copies of its period, counted exactly; of equal ones the first, then that of the smallest
    period. Null if there is none. ``runs`` are ordered by start and period."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)
