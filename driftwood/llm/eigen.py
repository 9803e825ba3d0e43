"""Leading eigenpairs of a small symmetric matrix: tridiagonal form by Householder reflections, eigenvalues by
bisection on Sturm counts, eigenvectors by inverse iteration with reorthogonalisation in clusters."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections' unit vectors (vector k acts on places k + 1 on)."""
    a, n = np.array(a, dtype=float), len(a)
    vectors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        long = np.linalg.norm(v)
        v = v / long if np.linalg.norm(x[1:]) > 0 and long > 0 else np.zeros_like(v)  # nothing to reflect
        rest = a[k + 1:, k + 1:]
        p = 2.0 * (rest @ v)
        w = p - (v @ p) * v
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] = x - 2.0 * v * (v @ x)
        vectors.append(v)
    return np.diag(a).copy(), np.array([a[i + 1, i] for i in range(n - 1)]), vectors


def count_below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``x``: the negative pivots of the shifted factorisation."""
    least = EPS * EPS * max(1.0, float(np.max(e * e, initial=0.0)))
    q = d[0] - x
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < least, -least, q)
        q = d[i] - x - e[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until the interval can't be halved."""
    n = len(d)
    reach = np.r_[0.0, np.abs(e)] + np.r_[np.abs(e), 0.0]
    size = max(float(np.max(np.abs(d) + reach)), np.finfo(float).tiny)
    low, high = np.full(k, float(np.min(d - reach)) - 4 * n * EPS * size), np.full(k, float(np.max(d + reach)) + 4 * n * EPS * size)
    rank = n - 1 - np.arange(k)  # eigenvalues below the one sought
    while True:
        mid = low + (high - low) / 2
        wide = (high - low) > 2 * EPS * np.maximum(np.abs(low), np.abs(high)) + EPS * EPS * size
        if not (wide & (mid > low) & (mid < high)).any():
            return mid
        over = count_below(d, e, mid) > rank
        high, low = np.where(wide & over, mid, high), np.where(wide & ~over, mid, low)


def factor(d: np.ndarray, e: np.ndarray, x: float, size: float) -> list[tuple[bool, float, float, float, float]]:
    """Gaussian elimination with row exchanges of the shifted tridiagonal matrix: (exchanged, multiplier, pivot and the two
    places right of it) for each row."""
    n, rows = len(d), []
    a, b, c = d[0] - x, e[0] if n > 1 else 0.0, 0.0
    for i in range(n - 1):
        below, next_a, next_b = e[i], d[i + 1] - x, e[i + 1] if i + 2 < n else 0.0
        if abs(a) >= abs(below):
            a = a if a else EPS * size
            m = below / a
            rows.append((False, m, a, b, c))
            a, b, c = next_a - m * b, next_b, 0.0
        else:
            m = a / below
            rows.append((True, m, below, next_a, next_b))
            a, b, c = b - m * next_a, -m * next_b, 0.0
    rows.append((False, 0.0, a if abs(a) > EPS * EPS * size else EPS * size, 0.0, 0.0))
    return rows


def solve(rows: list, y: np.ndarray) -> np.ndarray:
    y, n = y.tolist(), len(rows)
    for i, (exchanged, m, *_) in enumerate(rows[:-1]):
        if exchanged:
            y[i], y[i + 1] = y[i + 1], y[i]
        y[i + 1] -= m * y[i]
    out = [0.0] * (n + 2)
    for i in range(n - 1, -1, -1):
        _, _, pivot, b, c = rows[i]
        out[i] = (y[i] - b * out[i + 1] - c * out[i + 2]) / pivot
    return np.array(out[:n])


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns.  Values closer than a thousandth of the matrix's size to the one before are
    a cluster, whose vectors are kept orthogonal during the iteration."""
    n, size = len(d), max(float(np.max(np.abs(d))), float(np.max(np.abs(e), initial=0.0)), np.finfo(float).tiny)
    rng, out, cluster = np.random.default_rng(11), [], 0
    for k, value in enumerate(values):
        cluster = cluster if k and abs(values[k - 1] - value) <= 1e-3 * size else k
        # Equal values are shifted a little apart, so that each has its own solution.
        shift = value - 10 * EPS * size * (k - cluster)
        rows, y = factor(d, e, shift, size), rng.standard_normal(n)
        y /= np.linalg.norm(y)
        for _ in range(8):
            y = solve(rows, y / n)
            y /= np.max(np.abs(y))
            for _ in range(2):
                for other in out[cluster:k]:
                    y = y - (other @ y) * other
            y /= np.linalg.norm(y)
            left = d * y - value * y
            left[:-1] += e * y[1:]
            left[1:] += e * y[:-1]
            if np.max(np.abs(left)) <= 4 * EPS * size:
                break
        out.append(y)
    return np.stack(out, axis=1) if out else np.zeros((n, 0))


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.  A vector's entry of the largest
    size is positive (the first one of equals)."""
    a = np.array(matrix, dtype=float)
    n, k = len(a), min(k, len(a))
    if not k:
        return np.zeros(0), np.zeros((n, 0))
    scale = float(np.max(np.abs(a)))
    if scale == 0.0:
        return np.zeros(k), np.eye(n)[:, :k]
    d, e, reflections = tridiagonal(a / scale)
    values = leading_values(d, e, k)
    vectors = tridiagonal_vectors(d, e, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1:] -= 2.0 * np.outer(v, v @ vectors[i + 1:])
    top = np.argmax(np.abs(vectors) > np.max(np.abs(vectors), axis=0) * (1 - 1e-9), axis=0)
    return values * scale, vectors * np.where(vectors[top, np.arange(k)] < 0, -1.0, 1.0)
