"""Embedding whitening: vectors are centred, turned to the principal components of their covariance and scaled to
unit variance.

Coordinates are whole numbers (``on_grid`` makes them from floats), so sums and deviations are exact in any order.

Method: each task centres its rows block by block and reduces them by QR to one small triangle; triangles meet
in two rounds of ever fewer tasks, and only the last few reach the driver, whatever the number of rows. The covariance
itself is never formed, which would square the condition. There Householder reflections bring the triangle to
bidiagonal form, dqds finds its singular values and twisted factorisations the vectors (``bidiagonal``). A last
pass projects every row.

State: a task holds one block of ``BLOCK`` rows and a triangle of dimension squared; the model (means and up to
``components`` directions) is broadcast and does not grow with the rows. All passes read the input again, so a lost
executor costs its own tasks only.

Defined results: vectors that are null, or hold a null, a non-finite entry or one beyond ``LIMIT``, are dropped; so are
those whose length is not the commonest one (of equally common lengths the largest); keys may be null or repeated, every
row counts; components without variance (up to rounding) are left out, so a table of equal vectors, of one row or of
none gives an empty result; other columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bidiagonal

BLOCK = 4_096
LIMIT = float(1 << 46)
MEETINGS = (64, 8)
# A standard deviation under this share of the largest one (times the dimension) is rounding.
NO_VARIANCE = 16 * bidiagonal.EPS


@dataclass(frozen=True)
class Whitening:
    """What the fit list is turned with. ``variances`` are those of the ``directions`` (columns), falling."""
    rows: int
    sums: tuple[int, ...]
    total: float
    variances: np.ndarray
    directions: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.rows, np.array(self.sums, np.int64))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)


def _centred(x: np.ndarray, rows: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / rows; the whole part is taken off exactly."""
    return (x - sums // rows).astype(float) - (sums % rows) / rows


def on_grid(vectors: DataFrame, key: str, column: str, scale: int, offset: int) -> DataFrame:
    """``key, x``: floor(scale * entry) + offset of each entry of the usable vectors of one length."""
    entries = F.transform(F.col(f"`{column}`"), lambda c: c.cast("double") * F.lit(float(scale)))
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    fit = vectors.select(F.col(f"`{key}`").alias("key"), entries.alias("v")).where(F.col("v").isNotNull() & usable)
    lengths = fit.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    length = common["length"] if common else 0
    # Entries beyond the limit are added to as well before the filter drops them: those sums may fail.
    grid = F.transform("v", lambda c: F.try_add(F.floor(c).cast("bigint"), F.lit(offset).cast("bigint")))
    return fit.where(F.size("v") == length).select("key", grid.alias("x"))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _gathered(points: DataFrame, add: Callable, join: Callable) -> np.ndarray | None:
    """One array for all rows: ``add(state, block)`` within tasks, ``join(state, state)`` where tasks meet."""
    def packed(state: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if state is not None:
            yield pa.record_batch({"rows": pa.array([len(state)], pa.int64()), "state": pa.array([state.tobytes()], pa.binary())})

    def opened(rows: int, state: bytes) -> np.ndarray:
        return np.frombuffer(state).reshape(rows, -1)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for block in _blocks(batches):
            if block.num_rows:
                state = add(state, _rows(block))
        yield from packed(state)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for rows, other in zip(batch.column("rows").to_pylist(), batch.column("state").to_pylist(), strict=True):
                state = opened(rows, other) if state is None else join(state, opened(rows, other))
        yield from packed(state)

    kind = "rows bigint, state binary"
    states = points.select("x").mapInArrow(start, kind)
    for tasks in MEETINGS:
        states = states.repartition(tasks).mapInArrow(meet, kind)
    last = None
    for r in states.collect():
        last = opened(r["rows"], bytes(r["state"])) if last is None else join(last, opened(r["rows"], bytes(r["state"])))
    return last


def fit(points: DataFrame, components: int) -> Whitening | None:
    """The whitening of ``points(x array<bigint>)``, all of one length; None if nothing varies."""
    sums = points.select(F.posexplode("x").alias("place", "x")).groupBy("place").agg(
        F.sum(F.col("x").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"), F.count(F.lit(1)).alias("n")
    ).orderBy("place").collect()
    if not sums or sums[0]["n"] < 2:
        return None
    rows, totals = sums[0]["n"], tuple(int(r["total"]) for r in sums)
    exact = np.array(totals, np.int64)

    def add(triangle: np.ndarray | None, x: np.ndarray) -> np.ndarray:
        block = _centred(x, rows, exact)
        return np.linalg.qr(block if triangle is None else np.concatenate([triangle, block]), mode="r")

    triangle = _gathered(points, add, lambda a, b: np.linalg.qr(np.concatenate([a, b]), mode="r"))
    size = len(totals)
    square = np.zeros((size, size))
    square[:len(triangle)] = triangle
    diagonal, superdiagonal, rights = bidiagonal.reduced(square)
    values, vectors = bidiagonal.singular(diagonal, superdiagonal, (NO_VARIANCE * size) ** 2, components)
    if not vectors.shape[1]:
        return None
    directions = bidiagonal.restored(vectors, rights)
    return Whitening(rows, totals, float(values.sum()) / rows, values[:vectors.shape[1]] / rows, directions)


def identity_error(points: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity."""
    count = len(model.variances)

    def add(state: np.ndarray | None, x: np.ndarray) -> np.ndarray:
        w = model.whiten(x)
        own = np.concatenate([w.T @ w, w.sum(axis=0)[None, :]])
        return own if state is None else state + own

    state = _gathered(points, add, np.add) / model.rows
    # The rows are centred already; what is left of their mean is rounding.
    return float(np.abs(state[:count] - np.outer(state[count], state[count]) - np.eye(count)).max())


def deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Sum over the dimensions of (n * x - S)^2 of each row, exact."""
    sums = np.array(model.sums, np.int64)
    least, most = int(x.min(initial=0)), int(x.max(initial=0))
    reach = max(abs(model.rows * v - s) for v in (least, most) for s in model.sums)
    if len(sums) * reach * reach < 1 << 63:
        return ((model.rows * x - sums) ** 2).sum(axis=1)
    # Too long for 64 bits here and there: whole numbers of any size; a sum that does not fit is an error.
    wide = (model.rows * x.astype(object) - np.array(model.sums, object)) ** 2
    return np.array(wide.sum(axis=1), dtype=np.int64)


def apply(points: DataFrame, model: Whitening | None, key: str) -> DataFrame:
    """``key, component, n, deviation, whitened, explained`` of each row and component."""
    kind = points.schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double"
    if model is None:
        return points.sparkSession.createDataFrame([], schema)
    shared = points.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned = shared.value
        count = len(turned.variances)
        shares = turned.variances / turned.total
        for block in _blocks(batches):
            x, rows = _rows(block), block.num_rows
            if not rows:
                continue
            spread = pa.array(np.repeat(np.arange(rows), count))
            yield pa.record_batch({
                key: block.column(0).take(spread), "component": np.tile(np.arange(1, count + 1, dtype=np.int32), rows),
                "n": np.full(rows * count, turned.rows), "deviation": np.repeat(deviations(x, turned), count),
                "whitened": turned.whiten(x).ravel(), "explained": np.tile(shares, rows),
            })

    return points.select("key", "x").mapInArrow(work, schema)

