"""Byte-level BPE with a given vocabulary: encoding by a segment tree over adjacent pair ranks, and decoding.

A piece of text (what the splitting pattern yields) starts as its bytes. A segment tree holds, for each place, the
merge rank of the pair that starts there; every inner node holds the least of its two children as rank and place in
one number, so the root is the leftmost pair of lowest rank. A merge changes three leaves: the pair itself, the pair
before and the one that vanished, each updated along one path to the root. That repeats until the root says that no
pair can merge. A piece of n bytes costs n log n, so one huge word is no problem. Short pieces, nearly all, go
through the same tree side by side: one NumPy row each.

Work is per row and streams through ``mapInArrow``: nothing is shuffled or gathered, and a lost task is repeated
from its input. Words already met are remembered in a table of bounded size; it changes speed only.

Defined results: a null text encodes like the empty text (no ids); repeated rows give equal rows; an empty table
stays empty; extra columns are left out. The strings of special tokens in a text become their ids, as the public
library does by default.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts

# Fixed value: the pattern by which this family of vocabularies splits text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A blank before a letter always starts a new piece, so texts can be cut there first.
WORD_START = re.compile("(?= [A-Za-zÀ-ÖØ-öø-ɏ])")

NONE = np.int64(1) << 60
ROW_WIDTH = 32          # longer pieces go through the tree one by one
REMEMBERED = 100_000    # words in a worker's table
ROWS_IN_TREE = 2_048    # pieces side by side
ROWS_AT_ONCE = 400


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write the 256 bytes: printable ones as they are, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merge ranks and token bytes of one vocabulary file, and the encoder's table of known words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, model = byte_letters(), spec["model"]
        ids = model["vocab"]
        self.token_bytes = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.byte_ids = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_ids[b] = ids[letter]
        self.span = np.int64(max(ids.values()) + 1)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * int(self.span) + ids[b] for a, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: text.encode() for text, i in self.special.items()}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces = regex.compile(PIECES).findall
        every = range(max(self.token_bytes) + 1)
        self.contents = _table([self.token_bytes.get(i, b"") for i in every])
        self.spellings = _table([b"%d," % i for i in every])
        self.known: dict[str, tuple[bytes, int, bytes]] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair; NONE where there is no such merge or no such pair (an id under 0)."""
        pair = left * self.span + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((self.keys[at] == pair) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_long(self, piece: bytes) -> list[int]:
        """The ids of one piece of any length."""
        ids: list[int] = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, size, none = len(ids), 1, int(NONE)
        while size < n:
            size *= 2
        span, rank_of, merged = int(self.span), self.rank_of, self.merged
        tree = [none] * (2 * size)

        def rank(a: int, b: int) -> int:
            return rank_of.get(a * span + b, -1)

        for i in range(n - 1):
            if (r := rank(ids[i], ids[i + 1])) >= 0:
                tree[size + i] = r * size + i
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(place: int, value: int) -> None:
            k = size + place
            tree[k] = value
            while k > 1:
                k //= 2
                least = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == least:
                    break
                tree[k] = least

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while size > 1 and tree[1] < none:
            i, r = tree[1] % size, tree[1] // size
            gone = after[i]
            ids[i], ids[gone] = int(merged[r]), -1
            after[i] = right = after[gone]
            put(gone, none)
            if right < n:
                before[right] = i
            r = rank(ids[i], ids[right]) if right < n else -1
            put(i, r * size + i if r >= 0 else none)
            if (left := before[i]) >= 0:
                r = rank(ids[left], ids[i])
                put(left, r * size + left if r >= 0 else none)
        return [x for x in ids if x >= 0]

    def merge_rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Many pieces of at most ``width`` (a power of two) bytes, all rows at once: how many ids each has, and all ids."""
        n = len(pieces)
        flat = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(n, width)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        # One spare column on the right stands for the end of every row, and for what precedes its start.
        pitch = width + 1
        ids = np.full((n, pitch), -1, np.int64)
        ids[:, :width] = np.where(np.arange(width) < lengths[:, None], self.byte_ids[flat], -1)
        after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1)).ravel()
        before = np.tile(np.arange(-1, width), (n, 1))
        before[:, 0] = width
        before = before.ravel()
        tree = np.full((n, 2 * width), NONE, np.int64)
        ranks = self._ranks(ids[:, :width], ids[:, 1:])
        tree[:, width:] = np.where(ranks < NONE, ranks * width + np.arange(width), NONE)
        for k in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        ids, tree, merged = ids.ravel(), tree.ravel(), self.merged
        levels = width.bit_length() - 1

        def put(bases: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
            """Set leaves, then the least of two children along their paths to the roots."""
            k = width + places
            tree[bases + k] = values
            for _ in range(levels):
                k >>= 1
                child = bases + 2 * k
                tree[bases + k] = np.minimum(tree.take(child), tree.take(child + 1))

        rows = np.flatnonzero(tree[1::2 * width] < NONE)
        while len(rows):
            row, base = rows * pitch, rows * (2 * width)
            root = tree.take(base + 1)
            i, rank = root % width, root // width
            gone = after.take(row + i)
            right, left = after.take(row + gone), before.take(row + i)
            pair = merged.take(rank)
            ids[row + i], ids[row + gone], after[row + i] = pair, -1, right
            inner = right < width
            before[(row + right)[inner]] = i[inner]
            now = self._ranks(pair, ids.take(row + right))
            ahead = self._ranks(ids.take(row + left), pair)
            inner = left < width
            put(
                np.concatenate([base, base, base[inner]]), np.concatenate([gone, i, left[inner]]),
                np.concatenate([
                    np.full(len(rows), NONE), np.where(now < NONE, now * width + i, NONE),
                    np.where(ahead < NONE, ahead * width + left, NONE)[inner],
                ]),
            )
            rows = rows[tree.take(base + 1) < NONE]
        kept = (ids >= 0).reshape(n, pitch)
        return kept.sum(1), ids[kept.ravel()]

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of many pieces: how many ids each has, and all ids in their order."""
        counts, parts = np.zeros(len(pieces), np.int64), {}
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        widths = np.select([lengths <= 8, lengths <= 16, lengths <= ROW_WIDTH], [8, 16, ROW_WIDTH], 0)
        for width in np.unique(widths).tolist():
            places = np.flatnonzero(widths == width).tolist()
            step = 1 if not width else ROWS_IN_TREE
            for k in range(0, len(places), step):
                some = places[k:k + step]
                if width:
                    counts[some], ids = self.merge_rows([pieces[p] for p in some], width)
                else:
                    ids = np.array(self.merge_long(pieces[some[0]]), np.int64)
                    counts[some] = len(ids)
                parts[width, k] = some, ids
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        for some, ids in parts.values():
            own = counts[some]
            out[np.arange(len(ids)) + np.repeat(starts[some] - (np.cumsum(own) - own), own)] = ids
        return counts, out

    def learn(self, words: list[str]) -> None:
        """Put new words into the table: their ids as text, how many, and the bytes that the ids stand for."""
        pieces: list[str] = []
        owned = []
        for w in words:
            # Most words are one piece, or a piece and a mark at its end.
            body = w[1:] if w[0] == " " else w
            if body.isalpha():
                pieces.append(w)
                owned.append(1)
            elif body and body[-1] in ".,;:!?" and body[:-1].isalpha():
                pieces += (w[:-1], w[-1])
                owned.append(2)
            else:
                cut = self.pieces(w)
                pieces += cut
                owned.append(len(cut))
        # Each different piece is merged once, however many words hold it.
        numbers: dict[str, int] = {}
        met = np.fromiter((numbers.setdefault(p, len(numbers)) for p in pieces), np.int64, len(pieces))
        sizes, merged = self.merge([p.encode() for p in numbers])
        counts = sizes[met]
        starts = (np.cumsum(sizes) - sizes)[met] - (np.cumsum(counts) - counts)
        ids = merged[np.arange(int(counts.sum())) + np.repeat(starts, counts)]
        ends = np.cumsum(counts)[np.cumsum(owned) - 1]
        text, text_at = _spelled(ids, *self.spellings)
        data, data_at = _spelled(ids, *self.contents)
        text_at, data_at = text_at[ends].tolist(), data_at[ends].tolist()
        sizes = np.diff(ends, prepend=0).tolist()
        known, a, b = self.known, 0, 0
        for word, n, c, d in zip(words, sizes, text_at, data_at, strict=True):
            known[word] = (text[a:c], n, data[b:d])
            a, b = c, d

    def words(self, text: str) -> list[str]:
        """``text`` cut where a piece surely starts; special tokens stand alone."""
        if self.special_cut is None or not any(s in text for s in self.special):
            cut = WORD_START.split(text)
            return cut if cut[0] else cut[1:]
        parts = self.special_cut.split(text)
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else WORD_START.split(part)) if w]

    def encode(self, texts: list[str]) -> Iterator[list[tuple[bytes, int, bytes]]]:
        """Each text as its words' entries: ids (each with a comma behind it), number of ids, decoded bytes."""
        known = self.known
        for content, i in self.special.items():
            known[content] = (b"%d," % i, 1, self.token_bytes[i])
        cut = [self.words(t) for t in texts]
        distinct = set(chain.from_iterable(cut))
        fresh = list(distinct.difference(known))
        if fresh:
            self.learn(fresh)
        entry = known.__getitem__
        for words in cut:
            yield list(map(entry, words))
        if len(known) > REMEMBERED:
            if 2 * len(fresh) > len(distinct):
                # The table no longer fits the texts that come; the words of the last ones do sooner.
                kept = {word: known[word] for word in distinct} if len(distinct) <= REMEMBERED else {}
                known.clear()
                known.update(kept)
            else:
                for word in fresh:
                    del known[word]


def _table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(sizes) - sizes, sizes


def _spelled(ids: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The values of all ids behind one another, and where each ends (with a 0 before)."""
    own = sizes.take(ids)
    ends = np.cumsum(own)
    out = data.take(np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts.take(ids) - (ends - own), own))
    return out.tobytes(), np.concatenate([[0], ends])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker."""
    return Vocabulary(path)


def decode(ids: list[int], path: str) -> str:
    """The text that ids stand for; bytes that are no UTF-8 become replacement characters."""
    known = vocabulary(path).token_bytes
    return b"".join(known[i] for i in ids if i in known).decode("utf-8", "replace")


def _blocks(batches: Iterator[pa.RecordBatch], vocab: Vocabulary) -> Iterator[tuple[pa.Array, list[str]]]:
    """Blocks of few rows, so that memory stays bounded; the table of words is emptied when the task ends."""
    try:
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield keys.slice(at, ROWS_AT_ONCE), [t or "" for t in texts.slice(at, ROWS_AT_ONCE).to_pylist()]
    finally:
        vocab.known.clear()


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of token ids) and ``decoded``, the text decoded from them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for keys, texts in _blocks(batches, vocab):
            rows = [(b"".join([e[0] for e in row]), b"".join([e[2] for e in row])) for row in vocab.encode(texts)]
            yield pa.record_batch({
                "doc_id": keys,
                "ids": pa.array([[int(i) for i in ids.split(b",")[:-1]] for ids, _ in rows], pa.list_(pa.int32())),
                "decoded": pa.array([b.decode("utf-8", "replace") for _, b in rows], pa.string()),
            })

    return map_texts(docs.select("doc_id", F.col("text")), f"doc_id {kind}, ids array<int>, decoded string", work)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: what ``encode`` gives, as digests of bounded size."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for keys, texts in _blocks(batches, vocab):
            counts, ids, decoded = [], [], []
            for row in vocab.encode(texts):
                counts.append(sum(e[1] for e in row))
                ids.append(sha(b"".join([e[0] for e in row])[:-1]))
                decoded.append(sha(b"".join([e[2] for e in row]).decode("utf-8", "replace").encode()))
            yield pa.record_batch({
                "doc_id": keys, "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(decoded, pa.string()),
            })

    return map_texts(
        docs.select("doc_id", F.col("text")),
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", work,
    )
