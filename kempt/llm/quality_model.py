"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text is cut into words and runs of marks; single ones and neighbouring pairs are hashed into ``BINS`` places (a pair
of equal words has a place of its own, whatever the word). Counts, scaled to one length, make a sparse vector,
and the score is the logistic of its dot product with the weights.

Training: a bounded sample of labelled rows (``SAMPLE``, picked by a hash of the key) is dealt into ``SHARDS`` groups.
Each group runs FTRL-Proximal with per-place rates over its rows, ``EPOCHS`` times in hash order, and the weights of
the groups are averaged. A group's vectors are bounded by the sample; one weight vector per group reaches the driver.
Scoring streams all rows through ``mapInArrow`` without a shuffle.

Defined results: a null text scores like the empty text, whose vector holds the bias only; of conflicting labels of one
key the lowest counts, null labels are left out; without any label every score is 0.5; repeated rows give equal rows;
an empty table stays empty; extra columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_texts

BINS = 1 << 18
SAMPLE = 16_000
SHARDS = 8
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.02
LENGTH = 4.0

TOKENS = re.compile(r"\w+|[^\w\s]+")
SAME = 1                 # the place of a pair of equal words
KNOWN_WORDS = 50_000
_numbers: dict[str, int] = {}


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's vector. Place 0 is the bias."""
    words = TOKENS.findall(text.lower())
    if len(_numbers) > KNOWN_WORDS:
        _numbers.clear()
    numbers = _numbers
    for w in set(words).difference(numbers):
        numbers[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
    single = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    pair = (single[:-1] * np.uint64(0x9E3779B97F4A7C15) + single[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)
    places = np.concatenate([single, pair]) % np.uint64(BINS - 2) + np.uint64(2)
    places[len(single):][single[:-1] == single[1:]] = SAME
    places, counts = np.unique(places.astype(np.int32), return_counts=True)
    values = counts * (LENGTH / max(np.linalg.norm(counts), 1e-12))
    return np.concatenate([[0], places]).astype(np.int32), np.concatenate([[1.0], values]).astype(np.float32)


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-min(max(x, -30.0), 30.0))))


class Ftrl:
    """FTRL-Proximal: z gathers adjusted gradients, n their squares; weights follow from both in closed form."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(BINS), np.zeros(BINS)

    def weights(self, places: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        shrunk = np.maximum(np.abs(z) - L1, 0)
        return -np.sign(z) * shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        g = (logistic(float(w @ values)) - label) * values
        n = self.n[places]
        self.z[places] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[places] = n + g * g


def fit(docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE) -> np.ndarray:
    """Weights from the rows of ``labels(doc_id, quality)`` for which ``train`` (over doc_id) holds."""
    known = labels.where(train).groupBy("doc_id").agg(F.min("quality").alias("label")).where("label is not null")
    n = known.count()
    order = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30))
    picked = known.withColumn("order", order).where(F.col("order") < min(1.0, sample / max(n, 1)) * (1 << 30))
    # At most about ``sample`` short rows: small by construction.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("order", "label", "text")

    def vectorize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [features(t.as_py() or "") for t in batch.column("text")]
            yield pa.record_batch({
                "order": batch.column("order"), "label": batch.column("label").cast(pa.int32()),
                "places": pa.array([p.tobytes() for p, _ in pairs], pa.binary()),
                "amounts": pa.array([v.tobytes() for _, v in pairs], pa.binary()),
            })

    def train_group(table: pa.Table) -> pa.Table:
        table = table.sort_by("order")
        leader = Ftrl()
        rows = [
            (np.frombuffer(p, np.int32), np.frombuffer(v, np.float32), y) for p, v, y in zip(
                table["places"].to_pylist(), table["amounts"].to_pylist(), table["label"].to_pylist(), strict=True
            )
        ]
        for _ in range(EPOCHS):
            for row in rows:
                leader.learn(*row)
        weights = leader.weights(slice(None)).astype(np.float32).tobytes()
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "weights": pa.array([weights], pa.binary())})

    vectors = rows.mapInArrow(vectorize, "order bigint, label int, places binary, amounts binary")
    groups = vectors.groupBy(F.col("order") % SHARDS).applyInArrow(train_group, "n bigint, weights binary").collect()
    if not groups:
        return np.zeros(BINS, np.float32)
    total = sum(g["n"] for g in groups)
    return sum(np.frombuffer(g["weights"], np.float32) * np.float32(g["n"] / total) for g in groups)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            pairs = (features(t.as_py() or "") for t in batch.column("text"))
            scores = [logistic(float(w[p] @ v)) for p, v in pairs]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    return map_texts(docs.select("doc_id", F.col("text")), f"doc_id {kind}, score double", work)
