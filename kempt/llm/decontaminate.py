"""Benchmark decontamination: approximate occurrences of test items in documents, by pigeonhole pieces and Myers' search.

Both sides are lower-cased and runs of white space become one blank. An item of m characters may occur with up to
``rate * m`` edits. Split into one more piece than that, an occurrence leaves some piece untouched: so all pieces of all
items are searched at once (Aho-Corasick, one pass over each text), each hit names the stretch of text in which its
item would have to lie, and Myers' bit-parallel edit distance (the item as one long bit vector) searches overlapping
stretches once. No occurrence within the budget is missed, none beyond it is reported. Items under ``min_chars``
normalised characters, which edits would soon turn into other words, may occur only without edits and with whole words
at both ends.

The items are a stated query set. They are measured first and taken in blocks of at most about ``BLOCK_BYTES``; each
block goes to all tasks and meets all documents in one streaming pass without a shuffle, so neither side need be small.

Defined results: null or empty texts and items match nothing; an item with several texts matches by its best one; repeated rows give equal rows; empty tables give an empty result;
extra columns are left out (``keep_clean`` returns all columns of its input).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts

RATE = 0.08
MIN_CHARS = 32
BLOCK_BYTES = 4 << 20


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _in_word(c: str) -> bool:
    return c.isalnum() or c == "_"


class Pattern:
    """One item: its error budget, and the masks that say where each character stands in it."""

    def __init__(self, item_id: object, text: str, rate: float, min_chars: int) -> None:
        self.item_id, self.text, self.size = item_id, text, len(text)
        self.exact = len(text) < min_chars
        self.budget = 0 if self.exact else int(rate * len(text))
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def pieces(self) -> Iterator[tuple[int, str]]:
        """Budget + 1 pieces of nearly equal length, with their places."""
        n = self.budget + 1
        cuts = [self.size * i // n for i in range(n + 1)]
        return ((a, self.text[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True))

    def whole_at(self, text: str, start: int) -> bool:
        """Whether the item, standing at ``start``, does not cut a word of the text at either end."""
        end = start + self.size
        return not (start and _in_word(text[start - 1]) and _in_word(text[start])) and not (
            end < len(text) and _in_word(text[end - 1]) and _in_word(text[end])
        )

    def search(self, text: str) -> tuple[int, int]:
        """The least edit distance between the item and any part of ``text``, and where such a part ends first."""
        found = text.find(self.text)
        if found >= 0:
            return 0, found + self.size
        every, top = (1 << self.size) - 1, 1 << self.size - 1
        up, down, score = every, 0, self.size
        best, end = score, 0
        masks = self.masks.get
        for at, c in enumerate(text, 1):
            same = masks(c, 0)
            across = (((same & up) + up) ^ up) | same
            grows = down | (every & ~(across | up))
            falls = up & across
            if grows & top:
                score += 1
            elif falls & top:
                score -= 1
                if score < best:
                    best, end = score, at
            diagonal = same | down
            grows = grows << 1 & every
            up = (falls << 1 & every) | (every & ~(diagonal | grows))
            down = grows & diagonal
        return best, end


class Matcher:
    """All items of a block."""

    def __init__(self, items: tuple[tuple[object, str], ...], rate: float, min_chars: int) -> None:
        self.patterns = [Pattern(i, t, rate, min_chars) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, pattern in enumerate(self.patterns):
            for at, piece in pattern.pieces():
                places.setdefault(piece, []).append((number, at))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()

    def _stretches(self, text: str) -> Iterator[tuple[Pattern, int, int]]:
        """Per item, the joined stretches of text around its piece hits."""
        starts: dict[int, set[int]] = {}
        for last, (size, where) in self.pieces.iter(text):
            for number, at in where:
                start = last + 1 - size - at
                if not self.patterns[number].exact:
                    starts.setdefault(number, set()).add(start)
                elif number not in starts and self.patterns[number].whole_at(text, start):
                    starts[number] = {start}
        for number, found in starts.items():
            pattern, begin, end = self.patterns[number], None, 0
            for start in sorted(found):
                a, b = max(start - pattern.budget, 0), start + pattern.size + pattern.budget
                if begin is not None and a <= end:
                    end = b
                    continue
                if begin is not None:
                    yield pattern, begin, end
                begin, end = a, b
            yield pattern, begin, end

    def matches(self, raw: str | None) -> dict[object, tuple[int, int]]:
        """Item id -> (distance, end in the normalised text), best first by distance, then by place."""
        text = normalized(raw)
        found: dict[object, tuple[int, int]] = {}
        for pattern, begin, end in self._stretches(text):
            distance, stop = pattern.search(text[begin:end])
            if distance <= pattern.budget:
                one = (distance, begin + stop)
                found[pattern.item_id] = min(one, found.get(pattern.item_id, one))
        return found


@lru_cache(maxsize=2)
def _matcher(items: tuple[tuple[object, str], ...], rate: float, min_chars: int) -> Matcher:
    """One per Python worker and block."""
    return Matcher(items, rate, min_chars)


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple]:
    """The items as (id, normalised text), in blocks of bounded size; each block is fetched when it is its turn."""
    distinct = items.where(F.length("text") > 0).select("item_id", "text").distinct()
    total = distinct.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-total // block_bytes)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = distinct.where(number == block).collect()
        found = ((r["item_id"], normalized(r["text"])) for r in rows)
        kept = sorted({(i, t) for i, t in found if t}, key=lambda it: (it[1], str(it[0])))
        if kept:
            yield tuple(kept)


def find(
    docs: DataFrame, items: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, item_id, distance, match_end``: one row per document and item that occurs in it."""
    kinds = [docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, match_end int"
    context = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", F.col("text"))
    out = docs.sparkSession.createDataFrame([], schema)

    for block in item_blocks(items, block_bytes):
        shared = context.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value, rate, min_chars)
            for batch in batches:
                places, found = [], []
                for at, text in enumerate(batch.column("text")):
                    for item, match in matcher.matches(text.as_py()).items():
                        places.append(at)
                        found.append((item, *match))
                if places:
                    ids, distances, ends = zip(*found, strict=True)
                    yield pa.record_batch({
                        "doc_id": batch.column("doc_id").take(pa.array(places, pa.int64())),
                        "item_id": pa.array(ids), "distance": pa.array(distances, pa.int32()),
                        "match_end": pa.array(ends, pa.int32()),
                    })

        out = out.unionByName(map_texts(rows, schema, work))
    # An item's texts may lie in different blocks.
    best = F.min(F.struct("distance", "match_end")).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.distance", "best.match_end")


def keep_clean(
    docs: DataFrame, items: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which no item occurs."""
    for block in item_blocks(items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value, rate, min_chars)
            for batch in batches:
                clean = [not matcher.matches(t.as_py()) for t in batch.column("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = map_texts(docs, docs.schema, work)
    return docs
