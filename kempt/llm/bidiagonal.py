"""Singular values and right singular vectors of a small triangular matrix, by qd transforms.

``reduced`` brings the matrix to bidiagonal form with Householder reflections. ``dqds`` finds the squared singular values
of a bidiagonal matrix by differential qd transforms with shifts: only quotients, products and sums of positive numbers, so
small values keep their relative accuracy. ``twisted`` finds the vector of one value: the shifted matrix is factored
from the top and from the bottom, both factorisations meet where the remaining pivot is least, and the vector follows
from there by multiplications alone.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
NEGLIGIBLE = (10 * EPS) ** 2
SWEEPS = 200                    # per value; a shift that fails is lowered, without a shift every sweep succeeds
CLOSE = 1e-3                    # relative distance of values whose vectors are held apart explicitly


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta so that x - beta v (v.x) has zeros behind its first entry."""
    size = np.linalg.norm(x)
    if size == 0 or np.linalg.norm(x[1:]) == 0:
        return np.zeros_like(x), 0.0
    v = x / size
    v[0] += 1.0 if v[0] >= 0 else -1.0
    return v, 2.0 / float(v @ v)


def reduced(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, float]]]:
    """Diagonal, superdiagonal and the reflections of the right side of a square matrix."""
    a, rights = np.array(matrix, float), []
    size = len(a)
    for k in range(size):
        v, beta = reflector(a[k:, k].copy())
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < size - 2:
            v, beta = reflector(a[k, k + 1:].copy())
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
            rights.append((k + 1, v, beta))
    return a.diagonal().copy(), a.diagonal(1).copy(), rights


def _swept(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential transform; None if the shift is above the least value."""
    d, new_q, new_e = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        pivot = d + e[i]
        ratio = q[i + 1] / pivot if pivot > 0 else 0.0
        new_q.append(pivot)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift if pivot > 0 else q[i + 1] - shift
    return (new_q + [d], new_e) if d >= 0 else None


def _shift(q: list[float], e: list[float]) -> float:
    """A guess at the least value from the last two rows, less what couples them to the rest."""
    above = e[-2] if len(e) > 1 else 0.0
    x, y, z = q[-2] + above, q[-1] + e[-1], (q[-2] * e[-1]) ** 0.5
    half = (x - y) / 2
    root = (half * half + z * z) ** 0.5
    least = y - z * z / (half + root) if half > 0 else (x + y) / 2 - root
    share = z / max(((x - least) ** 2 + z * z) ** 0.5, 1e-300)
    coupling = (q[-3] * above) ** 0.5 * share if len(q) > 2 else 0.0
    return max(least - coupling, 0.0)


def dqds(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    scale = float(max(np.abs(diagonal).max(initial=0), np.abs(superdiagonal).max(initial=0)))
    if scale == 0:
        return np.zeros(len(diagonal))
    parts = [(((diagonal / scale) ** 2).tolist(), ((superdiagonal / scale) ** 2).tolist(), 0.0)]
    values: list[float] = []
    budget = SWEEPS * len(diagonal)
    while parts:
        q, e, moved = parts.pop()
        while len(q) > 1 and e[-1] <= NEGLIGIBLE * max(moved, min(q[-1], q[-2])):
            values.append(moved + q.pop())
            e.pop()
        if len(q) == 1:
            values.append(moved + q[0])
            continue
        if q[-1] == 0 or q[0] < q[-1] / 1.5:
            if q[0] != 0 or q[-1] != 0:
                # Turned round, the values are the same; the least should come last.
                if q[-1] != 0:
                    q, e = q[::-1], e[::-1]
        cut = next((i for i in range(len(e)) if e[i] <= NEGLIGIBLE * max(moved, min(q[i], q[i + 1]))), None)
        if cut is not None:
            parts += [(q[:cut + 1], e[:cut], moved), (q[cut + 1:], e[cut + 1:], moved)]
            continue
        shift = _shift(q, e)
        for tried in (shift, 0.9 * shift, shift / 4, shift / 64, 0.0):
            budget -= 1
            done = _swept(q, e, tried)
            if done is not None:
                break
        if budget < 0:
            raise ArithmeticError("the qd transforms do not converge")
        parts.append((*done, moved + tried))
    return np.sort(np.array(values))[::-1] * scale * scale


def twisted(diagonal: np.ndarray, superdiagonal: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of one eigenvalue of B'B for bidiagonal B, where both factorisations of B'B - value meet best."""
    size = len(diagonal)
    floor = EPS * float(np.abs(diagonal).max())
    a = [float(x) if abs(x) > floor * EPS else floor * EPS for x in diagonal]
    d, low = [x * x for x in a], [float(b) / x for b, x in zip(superdiagonal, a, strict=False)]
    tiny = max(floor * floor * EPS, 1e-300)
    held = lambda x: x if abs(x) > tiny else tiny
    s, down = [-value], []
    for i in range(size - 1):
        down.append(d[i] * low[i] / held(s[i] + d[i]))
        s.append(down[i] * low[i] * s[i] - value)
    p, up = [0.0] * (size - 1) + [d[-1] - value], [0.0] * (size - 1)
    for i in range(size - 2, -1, -1):
        ratio = d[i] / held(d[i] * low[i] * low[i] + p[i + 1])
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    k = min(range(size), key=lambda i: abs(s[i] + p[i] + value))
    z = np.zeros(size)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, size - 1):
        z[i + 1] = -up[i] * z[i]
    largest = np.abs(z).max()
    z = z / largest if np.isfinite(largest) else np.nan_to_num(z, nan=0.0, posinf=1.0, neginf=-1.0)
    return z / np.linalg.norm(z)


def _apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            z = z - (z @ o) * o
    return z


def _blocks(diagonal: np.ndarray, superdiagonal: np.ndarray) -> list[slice]:
    """Where the matrix falls apart into blocks that do not touch."""
    near = 8 * EPS * np.sqrt(np.abs(diagonal[:-1] * diagonal[1:]))
    ends = [0, *(np.flatnonzero(np.abs(superdiagonal) <= near) + 1).tolist(), len(diagonal)]
    return [slice(x, y) for x, y in zip(ends, ends[1:], strict=False) if y > x]


def singular(diagonal: np.ndarray, superdiagonal: np.ndarray, least: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a bidiagonal matrix, falling, and orthonormal right vectors (columns) of the
    first ``most`` that are at least ``least`` times the largest.

    Blocks are solved apart: one block has no value twice, and vectors of different blocks share no place. Vectors
    of values of one block that almost agree are held apart explicitly.
    """
    pairs = []
    for block in _blocks(diagonal, superdiagonal):
        inside = dqds(diagonal[block], superdiagonal[block.start:block.stop - 1])
        pairs += [(float(v), block) for v in inside]
    pairs.sort(key=lambda p: -p[0])
    size, vectors, values = len(diagonal), [], np.array([v for v, _ in pairs])
    for value, block in pairs[:most]:
        if value == 0 or value < least * values[0]:
            break
        close = [z for z, v, b in vectors if b == block and v - value <= CLOSE * v]
        z = np.zeros(size)
        z[block] = twisted(diagonal[block], superdiagonal[block.start:block.stop - 1], value)
        z = _apart(z, close)
        if np.linalg.norm(z) < 0.5:
            z = _another(diagonal, superdiagonal, block, value, close)
        vectors.append((z / np.linalg.norm(z), value, block))
    return values, np.stack([z for z, _, _ in vectors], axis=1) if vectors else np.zeros((size, 0))


def _another(diagonal, superdiagonal, block: slice, value: float, known: list[np.ndarray]) -> np.ndarray:
    """A vector of ``value`` off the known ones, where the factorisations meet at a known one again: inverse iteration."""
    b = np.diag(diagonal[block]) + np.diag(superdiagonal[block.start:block.stop - 1], 1)
    beside = b.T @ b - value * (1 + 16 * EPS) * np.eye(len(b))
    z = np.zeros(len(diagonal))
    z[block] = np.random.default_rng(len(known)).standard_normal(len(b))
    for _ in range(5):
        z = _apart(z, known)
        z[block] = np.linalg.solve(beside, z[block] / np.linalg.norm(z))
        z = _apart(z / np.linalg.norm(z), known)
    return z


def restored(vectors: np.ndarray, rights: list[tuple[int, np.ndarray, float]]) -> np.ndarray:
    """Vectors of the bidiagonal form as vectors of the matrix it came from."""
    out = vectors.copy()
    for k, v, beta in reversed(rights):
        out[k:] -= beta * np.outer(v, v @ out[k:])
    return out
