"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts elsewhere are removed.

Every row's text, as UTF-8, is a document; strings never cross documents. All bytes covered by a window of ``length`` bytes
that starts at two or more places (of one document or of several) go; windows are judged on the input.

Method: a distributed difference-cover suffix array (``suffix_array``) over content-defined phrases.

1. *Passages.* The least hash of the 64-byte grams of a window is an anchor; equal windows have equal anchors. Only windows
   whose own anchor's gram occurs twice can repeat, so only the passages they cover go on. Nothing else is decided by hash
   here.
2. *Phrases.* A passage is cut where the hash of the next eight bytes is small: at the same places in equal text, whatever
   surrounds it. A phrase reaches over the next cut, so none is a prefix of another, and phrases in the order of their
   bytes order suffixes as their bytes do. The suffix array of the phrase names is that of the suffixes that start
   at cuts.
3. *Adjacent prefixes.* Rows with ``length`` bytes behind a cut and the bytes before it, up to the cut before, are
   sorted by rank. Neighbours' common prefixes tell how far each suffix recurs. A window that starts d bytes before
   its first cut is the pair of these d bytes and the suffix's next ``length`` - d: if the suffixes that agree so far
   (an interval of the array) all have the same bytes before the cut, it recurs just if the interval has two members;
   otherwise the windows of the interval are compared with each other by fingerprints of 128 bits.
4. *Edges.* An interval that touches the edge of a task's rows is counted over the tasks, by fingerprint, one row per task
   and window; so are the few windows that hold no cut.

Tasks stream; what a task keeps is a bounded number of sorted rows (``ROWS_PER_TASK``). Equal suffixes are spread over
as many tasks as they fill, and a passage that a third of all documents share is counted inside each task before
anything is shuffled. The removed ranges of one document meet in one task, as its text does.

Defined results: a null text counts as empty; texts under ``length`` bytes lose nothing; each row is a document of its own,
also if key and text agree with another row's (then both lose what they share, as any copies); null keys are keys; an
empty table stays empty; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import settled
from .frames import map_texts, staged
from .suffix_array import gathered, suffix_ranks, totals_before

LENGTH = 200
GRAM = 64                   # bytes of an anchor, if windows have so many
LEAST = 32                  # the shortest windows that can be searched
CUT = 8                     # bytes whose hash makes a cut
PHRASE = 48                 # mean bytes between cuts
ROWS_PER_TASK = 25_000
BYTES_AT_ONCE = 1 << 18     # of texts that are hashed side by side
WINDOWS_AT_ONCE = 500_000
DOC = ["doc", "copy"]

# Odd factors that mix 64-bit words.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def words8(data: bytes | np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    size = max(len(data) - 7, 0)
    return np.ndarray((size,), "<u8", data, 0, (1,)) if size else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * FACTORS[1]
    return x ^ (x >> np.uint64(29))


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least or largest of each ``width`` neighbours, by doubling."""
    pick, have = np.minimum if least else np.maximum, 1
    while 2 * have <= width:
        x, have = pick(x[:-have], x[have:]), 2 * have
    return pick(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def side_by_side(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a binary column, some at a time: the first one's number, their bytes, and where they begin and end."""
    large = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(bounds, bounds[first] + BYTES_AT_ONCE, "right")) - 1, first + 1)
        yield first, every[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def gram_hashes(data: bytes | np.ndarray, gram: int) -> np.ndarray:
    """Of the ``gram`` bytes (8, 16, 32...) from each place on, by doubling."""
    h, have, k = words8(data) * FACTORS[0], 8, 1
    h ^= h >> np.uint64(32)
    while have < gram:
        longer = h[:-have] * FACTORS[k]
        longer += h[have:]
        h, have, k = longer, 2 * have, k % 3 + 1
    return mixed(h)


def gram_size(length: int) -> int:
    return GRAM if length >= 2 * GRAM else LEAST // 8 * 8


def least_grams(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts side by side, of ``length`` bytes or more together: the hashes of the grams, their order (never 0), and the
    least of each window; 0 for windows that reach into the next text."""
    h = gram_hashes(data, gram_size(length))
    order = np.maximum((h >> np.uint64(32)).astype(np.uint32), np.uint32(1))
    least = sliding(order, length - gram_size(length) + 1, least=True)
    if len(bounds) > 2:
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            least[max(end - length + 1, start):end] = 0
    return h, order, least


def anchor_places(order: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Places of the grams that are least in some window: the largest of the minima around it is a gram's own."""
    width = len(order) - len(least) + 1
    room = np.zeros(width - 1, np.uint32)
    return np.flatnonzero(sliding(np.concatenate([room, least, room]), width, least=False) == order)


def own_text(bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, places, "right") - 1


def anchors_beside(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts side by side, the places and hashes of the grams that are least in some window of ``length`` bytes."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, order, least = least_grams(data, bounds, length)
    places = anchor_places(order, least)
    return places, h[places]


def anchors(data: bytes, length: int) -> np.ndarray:
    """Hashes of the grams that are least in some window of ``length`` bytes."""
    return anchors_beside(np.frombuffer(data, np.uint8), np.array([0, len(data)]), length)[1]


def passages(data: bytes, repeated: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges of the windows whose own anchor is ``repeated``; those that overlap are one."""
    return passages_beside(np.frombuffer(data, np.uint8), np.array([0, len(data)]), repeated, length)


def passages_beside(data: np.ndarray, bounds: np.ndarray, repeated: np.ndarray, length: int) -> list[tuple[int, int]]:
    """``passages`` of texts side by side; none reaches into the next text."""
    if len(data) < length:
        return []
    h, order, least = least_grams(data, bounds, length)
    places = anchor_places(order, least)
    places = places[np.isin(h[places], repeated)]
    known = np.full(len(order), 0xFFFFFFFF, np.uint32)
    known[places] = order[places]
    starts = np.flatnonzero(sliding(known, len(order) - len(least) + 1, least=True) == least)
    if not len(places):
        return []
    # Windows that only touch may be of two texts.
    breaks = np.flatnonzero(np.diff(starts) >= length)
    first, last = starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)]
    return list(zip(first.tolist(), (last + length).tolist(), strict=True))


def cuts(data: bytes | np.ndarray, phrase: int) -> np.ndarray:
    return np.flatnonzero(mixed(words8(data) * FACTORS[0]) < np.uint64((1 << 64) // phrase))


class Windows:
    """Windows of ``length`` bytes, collected buffer by buffer and compared by 128-bit fingerprints.

    A fingerprint is a pair of polynomials of the bytes' random numbers, modulo 2^64.
    """

    def __init__(self, length: int) -> None:
        self.length, self.size, self.buffers, self.at = length, 0, [], 0
        self.parts: list[tuple[int, int, int, int, int]] = []

    def add(self, row: int, buffer: bytes, low: int, high: int, place: int) -> None:
        """The windows that start at ``low`` to ``high`` of the buffer, of which byte 0 is byte ``place`` of ``row``."""
        data = buffer[low:high + self.length]
        self.parts.append((row, self.at, high - low + 1, place + low, len(self.parts)))
        self.buffers.append(data)
        self.at += len(data)
        self.size += high - low + 1

    def listed(self) -> tuple[np.ndarray, ...]:
        """``part, row, start, h1, h2`` of all windows, buffer by buffer."""
        table = np.array(self.parts, np.int64).reshape(-1, 5)
        counts = table[:, 2]
        which = np.repeat(np.arange(len(table)), counts)
        step = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = table[which, 1] + step
        data = np.frombuffer(b"".join(self.buffers), np.uint8)
        hashes = []
        for numbers, base in fingerprint_tables():
            powers, inverse = powers_of(base, len(data) + 1), powers_of(pow(base, -1, 1 << 64), len(data) + 1)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(numbers[data] * powers[:len(data)], dtype=np.uint64)])
            hashes.append(mixed((sums[begin + self.length] - sums[begin]) * inverse[begin]))
        return which, table[which, 0], table[which, 3] + step, *hashes


@lru_cache(maxsize=1)
def fingerprint_tables() -> tuple[tuple[np.ndarray, int], ...]:
    random = np.random.default_rng(20_000)
    return tuple((random.integers(1, 1 << 63, 256, np.uint64), int(random.integers(1 << 40, 1 << 62)) | 1) for _ in range(2))


_powers: dict[int, np.ndarray] = {}


def powers_of(base: int, size: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64; kept between calls while short."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if len(known) <= 1 << 21:
            _powers[base] = known
    return known[:size]


def alike(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint whether another one equals it, and whether it is the first of its kind."""
    order = np.argsort(h1, kind="stable")
    if np.any((h1[order][1:] == h1[order][:-1]) & (h2[order][1:] != h2[order][:-1])):
        order = np.lexsort((h2, h1))
    same = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    again, first = np.zeros(len(h1), bool), np.zeros(len(h1), bool)
    again[order] = np.append(False, same) | np.append(same, False)
    first[order] = np.append(True, ~same)[:len(h1)]
    return again, first


def merged(part: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the first, first and last byte (exclusive) of what windows with consecutive starts cover."""
    if not len(part):
        return np.zeros(0, np.int64), start, start
    begins = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (start[1:] != start[:-1] + 1)))
    ends = np.append(begins[1:], len(part)) - 1
    return begins, start[begins], start[ends] + length


FOUND = "s bigint, start bigint, end bigint, h1 bigint, h2 bigint, n bigint"


def found_batch(ranges: list[tuple], unsure: list[tuple]) -> pa.RecordBatch:
    """Rows of ``FOUND``: ranges to remove (n is null), and windows to be counted over the tasks (n: 1, or 2 for more)."""
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in ([*zip(*ranges, strict=True)] or [[]] * 3)]
    open_ = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in ([*zip(*unsure, strict=True)] or [[]] * 6)]
    none = pa.nulls(len(columns[0]), pa.int64())
    out = {}
    for k, name in enumerate(("s", "start", "end", "h1", "h2", "n")):
        sure = pa.array(columns[k].astype(np.int64)) if k < 3 else none
        out[name] = pa.concat_arrays([sure, pa.array(open_[k].astype(np.int64))])
    return pa.record_batch(out)


def compared(windows: Windows, unsure: np.ndarray | None) -> tuple[list[tuple], list[tuple]]:
    """The ranges that repeated windows cover, and the windows to be counted further: one for each fingerprint among those
    whose part is ``unsure`` (None: all are)."""
    if not windows.parts:
        return [], []
    part, row, start, h1, h2 = windows.listed()
    again, first = alike(h1, h2)
    begins, starts, ends = merged(part[again], start[again], windows.length)
    ranges = [(row[again][begins], starts, ends)]
    open_ = first if unsure is None else first & unsure[part]
    told = (row[open_], start[open_], start[open_] + windows.length, h1[open_].view(np.int64), h2[open_].view(np.int64))
    return ranges, [(*told, np.where(again[open_], 2, 1))]


def without_cuts(length: int, phrase: int):
    """Compares the windows that hold no cut, batch by batch."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length)
        for batch in batches:
            for s, data in zip(batch.column("s").to_pylist(), batch.column("data").to_pylist(), strict=True):
                # Between two cuts, windows start behind the first and end before the whole second.
                edges = np.concatenate([[-1], cuts(data, phrase), [len(data) - CUT + 1]])
                wide = np.flatnonzero(np.diff(edges) > length - CUT + 1)
                for low, high in zip((edges[wide] + 1).tolist(), (edges[wide + 1] + CUT - 1 - length).tolist(), strict=True):
                    for at in range(low, high + 1, WINDOWS_AT_ONCE):
                        windows.add(s, data, at, min(high, at + WINDOWS_AT_ONCE - 1), 0)
                        if windows.size >= WINDOWS_AT_ONCE:
                            yield found_batch(*compared(windows, None))
                            windows = Windows(length)
        yield found_batch(*compared(windows, None))
    return work


def suffixes(length: int, phrase: int):
    """Rows ``rank, s, place, left, right`` of the cuts of passages: the bytes before, up to the cut before, and behind."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[np.ndarray, ...]] = []
            left, right = [], []
            ranks = batch.column("ranks")
            for k, (s, data) in enumerate(zip(batch.column("s").to_pylist(), batch.column("data").to_pylist(), strict=True)):
                places = cuts(data, phrase)
                low = np.maximum(np.append(0, places[:-1] + 1), np.maximum(places + CUT - length, 0))
                # Rows without a whole window have no say.
                chosen = low + length <= len(data)
                own = ranks[k].values.to_numpy()[chosen]
                low, places = low[chosen], places[chosen]
                rows.append((own, np.full(len(own), s), places))
                left += [data[a:b] for a, b in zip(low.tolist(), places.tolist(), strict=True)]
                right += [data[a:a + length] for a in places.tolist()]
            if rows:
                columns = [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)]
                yield pa.record_batch(
                    [*columns, pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                    names=["rank", "s", "place", "left", "right"],
                )
    return work


def neighbours(left: list[bytes], right: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Of sorted rows: how many bytes each right side shares with a neighbour, with the first or last row here, and with
    the nearest pair of neighbours whose left sides differ."""
    rows = len(right)
    table = np.frombuffer(b"".join(r.ljust(length, b"\0") for r in right), np.uint8).reshape(rows, length)
    sizes = np.fromiter(map(len, right), np.int64, rows)
    shared = np.empty(rows - 1, np.int64)
    for at in range(0, rows - 1, 4096):
        differ = table[at + 1:at + 4097] != table[at:min(at + 4096, rows - 1)]
        shared[at:at + 4096] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    shared = np.minimum(shared, np.minimum(sizes[1:], sizes[:-1]))
    recurs = np.maximum(np.append(0, shared), np.append(shared, 0))
    edge = np.maximum(
        np.minimum.accumulate(np.append(length, shared)), np.minimum.accumulate(np.append(shared, length)[::-1])[::-1]
    )
    turned = [a != b for a, b in zip(left, left[1:], strict=False)]
    up, down, depth = [-1] * rows, [-1] * rows, shared.tolist()
    for k in range(rows - 1):
        up[k + 1] = depth[k] if turned[k] else min(depth[k], up[k])
    for k in range(rows - 2, -1, -1):
        down[k] = depth[k] if turned[k] else min(depth[k], down[k + 1])
    return sizes, recurs, edge, np.maximum(up, down)


def judged(length: int):
    """Compares adjacent prefixes of a task's sorted rows: ``FOUND``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str, list] = {c: [] for c in ("s", "place", "left", "right")}
        for batch in batches:
            for c, values in columns.items():
                values.extend(batch.column(c).to_pylist())
        left, right = columns["left"], columns["right"]
        if not right:
            return
        s, place = np.array(columns["s"], np.int64), np.array(columns["place"], np.int64)
        sizes, recurs, edge, differ = neighbours(left, right, length)
        # d: how far before its cut a window starts; it needs length - d bytes of the right side.
        most = np.fromiter(map(len, left), np.int64, len(left))
        least = np.maximum(length - sizes, 0)
        high = np.minimum(most, length - np.maximum(differ, edge) - 1)
        low = np.maximum(least, length - recurs)
        plain = low <= high
        ranges = [(s[plain], (place - high)[plain], (place - low + length)[plain])]
        unsure: list[tuple] = []
        from_ = np.maximum(least, length - np.maximum(differ, edge))
        # Windows of mixed intervals, and behind them those of intervals that touch the edge of these rows.
        touches = np.maximum(least, length - edge)
        for outside in (False, True):
            a, b = (touches, most) if outside else (from_, np.minimum(most, length - edge - 1))
            windows, kinds = Windows(length), []
            for k in np.flatnonzero(a <= b).tolist():
                n = len(left[k])
                windows.add(int(s[k]), left[k] + right[k], n - int(b[k]), n - int(a[k]), int(place[k]) - n)
                kinds.append(outside)
            sure, open_ = compared(windows, np.array(kinds, bool))
            ranges += sure
            unsure += open_ if outside else []
        yield found_batch(ranges, unsure)
    return work


def _binary(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("copy"), text.cast("binary").alias("data"))


def _same_doc(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Joined by document; null keys are equal."""
    other = b.withColumnsRenamed({"doc": "doc_", "copy": "copy_"})
    return a.join(other, F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("copy") == F.col("copy_")), how).drop("doc_", "copy_")


def repeated_passages(docs: DataFrame, length: int) -> DataFrame:
    """``s, doc, copy, at, data``: the passages in which a window may repeat, numbered, with the byte they start at."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = _binary(docs).where(F.length("data") >= length)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in side_by_side(batch.column("data")):
                places, h = anchors_beside(data, bounds, length)
                row = own_text(bounds, places) + first
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))[:len(h)])
                index = pa.array(row[new])
                yield pa.record_batch({
                    "doc": batch.column("doc").take(index), "copy": batch.column("copy").take(index),
                    "h": h[new].view(np.int64), "n": np.diff(np.append(new, len(h))),
                })

    grams = staged(map_texts(whole, f"doc {kind}, copy bigint, h bigint, n bigint", listed), "grams")
    # Written, so that both sides of the join are dealt for it alone and the engine can split a hot gram.
    twice = staged(grams.groupBy("h").agg(F.sum("n").alias("total")).where("total > 1").select("h"), "grams")
    per_doc = grams.join(twice, "h").groupBy(*DOC).agg(F.collect_list("h").alias("grams"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, data = [], [], []
            for first, texts, bounds in side_by_side(batch.column("data")):
                # A gram that occurs twice does so in each text that holds it.
                known = batch.column("grams").slice(first, len(bounds) - 1).flatten().to_numpy().view(np.uint64)
                found = np.array(passages_beside(texts, bounds, known, length), np.int64).reshape(-1, 2)
                own = own_text(bounds, found[:, 0])
                rows += (own + first).tolist()
                at += (found[:, 0] - bounds[own]).tolist()
                data += [texts[start:end].tobytes() for start, end in found.tolist()]
            index = pa.array(rows, pa.int64())
            yield pa.record_batch({
                "doc": batch.column("doc").take(index), "copy": batch.column("copy").take(index),
                "at": pa.array(at, pa.int64()), "data": pa.array(data, pa.binary()),
            })

    found = map_texts(_same_doc(whole, per_doc, "inner"), f"doc {kind}, copy bigint, at bigint, data binary", cut)
    return found.withColumn("s", F.monotonically_increasing_id())


def phrase_strings(data: DataFrame, length: int, phrase: int) -> DataFrame:
    """Strings for the suffix array: the phrases of ``s, data`` behind each cut, named in the order of their bytes."""
    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column("s").to_numpy()
            for first, data, bounds in side_by_side(batch.column("data")):
                start = cuts(data, phrase)
                row = own_text(bounds, start)
                inside = start + CUT <= bounds[row + 1]
                start, row = start[inside], row[inside]
                new = np.append(True, row[1:] != row[:-1])[:len(row)]
                place = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
                end = np.where(np.append(new[1:], True)[:len(row)], bounds[row + 1], np.append(start[1:], 0)[:len(row)])
                # What lies beyond the longest prefix that counts need not be told apart.
                reach = np.minimum(np.minimum(end, start + length) + CUT, bounds[row + 1])
                text = data.tobytes()
                yield pa.record_batch({
                    "s": s[row + first], "i": place, "span": np.minimum(end - start, 1 << 30).astype(np.int32),
                    "phrase": pa.array([text[a:b] for a, b in zip(start.tolist(), reach.tolist(), strict=True)], pa.binary()),
                })

    tokens = map_texts(data, "s bigint, i bigint, span int, phrase binary", phrases).select(
        "s", "i", "span", "phrase", F.xxhash64("phrase").alias("p1"), F.xxhash64(F.lit("second"), "phrase").alias("p2")
    )
    distinct = tokens.select("p1", "p2", "phrase").distinct().withColumn("one", F.lit(1))
    names = staged(totals_before(distinct, ["phrase"], ["one"], ["p1", "p2"]), "phrases").withColumnRenamed("before_one", "name")
    return gathered(tokens.drop("phrase").join(names, ["p1", "p2"]).select("s", "i", "name", "span"))


def removed_ranges(docs: DataFrame, length: int = LENGTH, phrase: int = PHRASE) -> DataFrame:
    """``doc, copy, spans``: per document the byte ranges covered by windows that start elsewhere as well."""
    spark = docs.sparkSession
    pieces = settled(spark, lambda: repeated_passages(docs, length), "passages")
    data = pieces.select("s", "data")
    strings = settled(spark, lambda: phrase_strings(data, length, phrase), "strings")
    ranks = suffix_ranks(strings, length)
    rows = map_texts(
        data.join(ranks, "s"), "rank bigint, s bigint, place bigint, left binary, right binary", suffixes(length, phrase)
    )
    total = strings.agg(F.sum(F.size("names"))).first()[0] or 0
    parts = max(-(-total // ROWS_PER_TASK), 1)
    ordered = rows.repartitionByRange(parts, "rank", "s", "place").sortWithinPartitions("rank", "s", "place")
    found = settled(spark, lambda: ordered.mapInArrow(judged(length), FOUND).unionByName(
        map_texts(data, FOUND, without_cuts(length, phrase))
    ), "found")
    del rows, ordered
    counts = found.where("n is not null").groupBy("h1", "h2").agg(F.sum("n").alias("total")).where("total > 1")
    counts = staged(counts.select("h1", "h2"), "counts")
    late = found.where("n = 1").join(counts, ["h1", "h2"]).select("s", "start", "end")
    ranges = found.where("n is null").select("s", "start", "end").unionByName(late)
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = ranges.join(pieces.select("s", *DOC, "at"), "s").select(
        *DOC, "s", (F.col("start") + F.col("at")).alias("start"), (F.col("end") + F.col("at")).alias("end")
    )

    # Each cut has a range of its own, and a passage's come together here: what overlaps is one before it is gathered.
    def fewer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, end = joined_spans(*(batch.column(c).to_numpy() for c in ("s", "start", "end")))
            yield batch.select(["doc", "copy"]).take(pa.array(row)).append_column("start", pa.array(start)).append_column(
                "end", pa.array(end)
            )

    together = placed.mapInArrow(fewer, f"doc {kind}, copy bigint, start bigint, end bigint")
    return together.groupBy(*DOC).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def joined_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges with those of a row that touch or overlap made one, by row and start: the index of one of them, and
    where they start and end."""
    if not len(row):
        return np.zeros(0, np.int64), start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    new = np.append(True, row[1:] != row[:-1])
    # How far the ranges of a row reach so far: rows, numbered apart, stand one behind another.
    apart = (np.cumsum(new) - 1) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + apart)
    first = np.flatnonzero(new | np.append(True, (start + apart)[1:] > reach[:-1]))
    last = np.append(first[1:], len(row)) - 1
    return order[first], start[first], (reach - apart)[last]


def dedup(docs: DataFrame, length: int = LENGTH, phrase: int = PHRASE) -> DataFrame:
    """``doc_id, n_bytes, removed, kept``: the removed byte ranges (start, end), apart and ascending, and the bytes left.

    What is left need not be whole characters, so it is binary.
    """
    if length < LEAST:
        raise ValueError(f"strings of under {LEAST} bytes are not searched")
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranges = settled(docs.sparkSession, lambda: removed_ranges(docs, length, phrase), "ranges")
    layout = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("data").to_pylist(), batch.column("spans")
            counts = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
            row, flat = np.repeat(np.arange(len(texts)), counts), spans.flatten()
            index, start, end = joined_spans(row, *(flat.field(k).to_numpy() for k in (0, 1)))
            offsets = np.searchsorted(row[index], np.arange(len(texts) + 1))
            kept, starts, ends = texts, start.tolist(), end.tolist()
            for k in np.flatnonzero(np.diff(offsets)).tolist():
                own, data = slice(offsets[k], offsets[k + 1]), texts[k]
                edges = zip([0, *ends[own]], [*starts[own], len(data)], strict=True)
                kept[k] = b"".join([data[a:b] for a, b in edges])
            removed = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], fields=list(layout.value_type))
            yield pa.record_batch({
                "doc_id": batch.column("doc"), "n_bytes": pc.binary_length(batch.column("data")).cast(pa.int64()),
                "removed": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), removed, type=layout),
                "kept": pa.array(kept, pa.binary()),
            })

    schema = f"doc_id {kind}, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary"
    return map_texts(_same_doc(_binary(docs), ranges, "left").select("doc", "data", "spans"), schema, work)
