"""Language identification by the nearest of several centroids per language.

A text becomes a vector of its hashed character n-grams (lower case, everything but letters taken as a blank): damped
counts times inverse document frequency, at length 1. Each language has up to ``CENTROIDS`` centroids, found by
spherical k-means among its labelled texts, since one language may hold several kinds of text. A text goes to the
language of the centroid with the largest cosine. It is rejected when that cosine is far below what the labelled
texts of that language reach themselves.

Document frequencies are counted over all training rows, one vector per task, added up in a few tasks. The k-means
sees a bounded sample: at most ``SAMPLE`` texts, shared among the languages, picked by a hash of the row's key.
Vectors have ``BINS`` places whatever the data, so model and driver memory are bounded. Scoring streams through
``mapInArrow`` without a shuffle.

Defined results: a null text, or one without a letter, gives ``und`` with score 0 and is rejected, as is everything
when no row is labelled; equal cosines go to the language that sorts first; repeated rows give equal rows; an empty
table stays empty; extra columns are left out. The driver holds three centroids per label (48 KB); ``most_labels``,
off unless given, raises ValueError beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import map_texts

BINS = 4096
CENTROIDS = 3
SAMPLE = 2_000
ROUNDS = 12
REJECT_SHARE = 0.6      # of the similarity that all but 1 % of a language's sample reach
UNKNOWN = "und"
TEXTS_AT_ONCE = 128

# Odd multipliers for the places of 1-, 2- and 3-grams.
MIX = ((0x9E3779B1,), (0x85EBCA77, 0xC2B2AE3D), (0x27D4EB2F, 0x165667B1, 0xD3A2646D))


def _letters() -> np.ndarray:
    """A character's number if it is a letter, else that of a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], np.uint32)


LETTER = _letters()


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.where(chars < len(LETTER), LETTER[np.minimum(chars, len(LETTER) - 1)], chars)
    total = np.zeros(BINS, np.int64)
    for mixers in MIX:
        n = len(chars) - len(mixers) + 1
        if n > 0:
            code = np.zeros(n, np.uint32)
            for k, m in enumerate(mixers):
                code += chars[k:k + n] * np.uint32(m)
            total += np.bincount(code >> np.uint32(32 - BINS.bit_length() + 1), minlength=BINS)
    return total


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray            # BINS
    centroids: np.ndarray      # one row per centroid
    owner: np.ndarray          # the language of each centroid
    least: np.ndarray          # per language, the cosine below which a text is rejected

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the number of its language and its cosine."""
        cosines = vectors(np.stack([counts(t) for t in texts]), self.idf) @ self.centroids.T
        best = cosines.argmax(1)
        return self.owner[best], np.clip(cosines[np.arange(len(best)), best], 0, 1)


def vectors(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    damped = np.log1p(raw).astype(np.float32) * idf
    return damped / np.maximum(np.linalg.norm(damped, axis=1, keepdims=True), 1e-12)


def _centroids(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; the first centres are chosen far from one another, so nothing is random."""
    centres = [rows.mean(0)]
    nearest = rows @ (centres[0] / max(np.linalg.norm(centres[0]), 1e-12))
    chosen = [int(nearest.argmax())]
    while len(chosen) < min(k, len(rows)):
        nearest = (rows @ rows[chosen].T).max(1)
        if nearest.min() > 1 - 1e-6:
            break
        chosen.append(int(nearest.argmin()))
    centres = rows[chosen]
    for _ in range(ROUNDS):
        group = (rows @ centres.T).argmax(1)
        sums = np.stack([rows[group == g].sum(0) if (group == g).any() else centres[g] for g in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each n-gram occurs, and the number of texts: each task adds up its own, a few tasks those."""
    schema = "n bigint, df array<bigint>"

    def row(n: int, df: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"n": pa.array([n], pa.int64()), "df": pa.array([df], pa.list_(pa.int64()))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(BINS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                df += counts(text.as_py()) > 0
                n += 1
        yield row(n, df)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(BINS, np.int64)
        for batch in batches:
            n += sum(batch.column("n").to_pylist())
            for part in batch.column("df"):
                df += part.values.to_numpy()
        yield row(n, df)

    parts = map_texts(texts, schema, count).repartition(8).mapInArrow(add, schema).collect()
    return np.sum([p["df"] for p in parts], axis=0), sum(p["n"] for p in parts)


def fit(
    docs: DataFrame, train: Column, key: str = "doc_id", label: str = "lang", most_labels: int | None = None
) -> Model | None:
    """Learn from the rows for which ``train`` holds and label and text are not null; None if there are none."""
    rows = docs.where(train & F.col(label).isNotNull() & F.col("text").isNotNull()).select(
        F.col(key).alias("key"), F.col(label).alias("label"), "text"
    )
    by_label = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["label"]: r["n"] for r in (by_label if most_labels is None else by_label.limit(most_labels + 1)).collect()}
    if most_labels is not None and len(sizes) > most_labels:
        raise ValueError(f"over {most_labels} languages")
    if not sizes:
        return None
    each = max(SAMPLE // len(sizes), 1)
    df, n = _document_frequencies(rows.select("text"))
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(1)

    # Twice the wanted share, by hash; then exactly the first ones of each language.
    share = F.create_map(*[F.lit(x) for name, size in sizes.items() for x in (name, min(1.0, 2.0 * each / size))])
    order = F.xxhash64(F.col("key").cast("string"), F.lit("sample"))
    picked = rows.where(F.pmod(order, F.lit(1 << 20)) < F.element_at(share, F.col("label")) * (1 << 20))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(order, "text"))
    picked = picked.withColumn("rank", rank).where(F.col("rank") <= each).select("label", "text")

    def vectorize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [counts(t.as_py()).astype(np.int32).tobytes() for t in batch.column("text")]
            yield pa.record_batch({"label": batch.column("label"), "raw": pa.array(raw, pa.binary())})

    sample = map_texts(picked, "label string, raw binary", vectorize).collect()
    languages = tuple(sorted({r["label"] for r in sample}))
    centroids, owner, least = [], [], []
    for number, language in enumerate(languages):
        raw = np.stack([np.frombuffer(r["raw"], np.int32) for r in sample if r["label"] == language])
        own = vectors(raw, idf)
        found = _centroids(own, CENTROIDS)
        centroids.append(found)
        owner += [number] * len(found)
        least.append(REJECT_SHARE * np.quantile((own @ found.T).max(1), 0.01))
    return Model(languages, idf, np.concatenate(centroids), np.array(owner), np.array(least))


def _identify(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
    names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    known = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
    for at in range(0, len(known), TEXTS_AT_ONCE):
        block = known[at:at + TEXTS_AT_ONCE]
        found, cosines = model.predict([texts[i] for i in block])
        for i, language, cosine in zip(block, found.tolist(), cosines.tolist(), strict=True):
            names[i], scores[i], rejected[i] = model.languages[language], cosine, cosine < model.least[language]
    return names, scores, rejected


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, rejected = _identify(model, batch.column("text").to_pylist())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(scores, pa.float64()), "rejected": pa.array(rejected, pa.bool_()),
            })

    schema = f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    return map_texts(docs.select("doc_id", F.col("text")), schema, work)


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not rejected."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = _identify(model, batch.column("text").to_pylist())[2]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return map_texts(docs, docs.schema, work)
