"""Singular values and right vectors of a small square matrix by qd transformations.

Householder reflections make the matrix bidiagonal; dqds finds all singular values to high relative
accuracy; a twisted factorisation of the shifted product gives each right vector of the bidiagonal,
and the reflections carry it back. Vectors of values that are too near to each other to be told
apart one by one are found together, by inverse iteration of their space.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
#: Squared values whose relative distance is smaller belong to one cluster.
CLUSTER = 1e-4
#: Failed shifts before a step without a shift, which cannot fail.
TRIES = 4


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """The unit vector v for which x - 2 v (v.x) is a multiple of the first axis; None if x is."""
    scale = np.abs(x).max() if len(x) else 0.0
    if len(x) < 2 or scale == 0 or not np.any(x[1:]):
        return None
    v = x / scale
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal and superdiagonal, and the reflections of the columns from the second one on."""
    a, rights = np.array(matrix, float), []
    d = len(a)
    for k in range(d):
        v = _reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = _reflector(a[k, k + 1 :].copy())
        if v is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
        rights.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), rights


def carry_back(vectors: np.ndarray, rights: list[np.ndarray | None]) -> np.ndarray:
    """Right vectors of the matrix, as columns, for those of its bidiagonal."""
    vectors = vectors.copy()
    for k in range(len(rights) - 1, -1, -1):
        v = rights[k]
        if v is not None:
            vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return vectors


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One dqds transformation, and the last d; stops at the first d below 0 (but the last one)."""
    new_q, new_e = [0.0] * len(q), [0.0] * len(e)
    d = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return new_q, new_e, math.nan
        total = d + e[i]
        new_q[i] = total
        if total == 0:
            new_e[i], d = 0.0, q[i + 1] - shift
        else:
            part = q[i + 1] / total
            new_e[i] = e[i] * part
            d = d * part - shift
    new_q[-1] = d
    return new_q, new_e, d


def _smaller(a: float, b: float, c: float) -> float:
    """The smaller eigenvalue of the product of the bidiagonal with squares a, c and b above c."""
    total = a + b + c
    root = math.hypot((a - b - c) / 2, math.sqrt(a) * math.sqrt(b))
    return a * (c / (total / 2 + root)) if total else 0.0


def squared_values(q: list[float], e: list[float]) -> list[float]:
    """Squares of the singular values of the bidiagonal with squared diagonals q and e."""
    found: list[float] = []
    waiting = [(list(q), list(e), 0.0)]
    while waiting:
        q, e, sigma = waiting.pop()
        while len(q) > 1:
            n = len(q)
            if e[-1] <= EPS**2 * (sigma + q[-1]) or e[-1] < TINY:
                found.append(sigma + q.pop())
                e.pop()
                continue
            if n == 2:
                low = _smaller(q[0], e[0], q[1])
                high = q[0] + e[0] + q[1] - low
                found += [sigma + high, sigma + low]
                q = []
                break
            cut = next(
                (i for i in range(n - 2, -1, -1) if e[i] <= EPS**2 * min(q[i], q[i + 1])), None
            )
            if cut is not None:
                waiting.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # the small values belong to the end
                q, e = q[::-1], e[::-1]
            shift = _smaller(q[-2], e[-1], q[-1])
            for _ in range(TRIES):
                new_q, new_e, last = _step(q, e, shift)
                if last >= 0:
                    break
                # What the last d lacks makes a good shift; an early failure tells little.
                shift = max(0.0, shift + last) if last == last else shift / 4
                shift *= 1 - 4 * EPS
            else:
                shift = 0.0
                new_q, new_e, _ = _step(q, e, shift)
            q, e, sigma = new_q, new_e, sigma + shift
        if q:
            found.append(sigma + q[0])
    return sorted(found, reverse=True)


def _apart(pivot: float, value: float) -> float:
    """The pivot, moved away from zero by much less than the value's last digit."""
    least = EPS**2 * value
    return pivot if abs(pivot) > least else math.copysign(least, pivot)


def _stationary(diag: np.ndarray, low: np.ndarray, value: float):
    """L D L^T - value = L+ D+ L+^T: the entries of D+ and L+, and the s of each place."""
    d = len(diag)
    plus, under, s = np.empty(d), np.empty(d - 1), np.empty(d)
    s[0] = -value
    for i in range(d - 1):
        plus[i] = _apart(s[i] + diag[i], value)
        under[i] = diag[i] * low[i] / plus[i]
        s[i + 1] = under[i] * low[i] * s[i] - value
    plus[-1] = _apart(s[-1] + diag[-1], value)
    return plus, under, s


def _progressive(diag: np.ndarray, low: np.ndarray, value: float):
    """L D L^T - value = U- D- U-^T: the entries of U-, and the p of each place."""
    d = len(diag)
    over, p = np.empty(d - 1), np.empty(d)
    p[-1] = diag[-1] - value
    for i in range(d - 2, -1, -1):
        minus = _apart(diag[i] * low[i] ** 2 + p[i + 1], value)
        part = diag[i] / minus
        over[i] = low[i] * part
        p[i] = p[i + 1] * part - value
    return over, p


def _twisted(diag: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of the eigenvalue of L D L^T next to ``value``."""
    for _ in range(3):
        _, under, s = _stationary(diag, low, value)
        over, p = _progressive(diag, low, value)
        gamma = s + p + value
        k = int(np.nanargmin(np.abs(gamma)))
        z = np.zeros(len(diag))
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -under[i] * z[i + 1]
        for i in range(k, len(z) - 1):
            z[i + 1] = -over[i] * z[i]
        size = float(z @ z)
        correction = gamma[k] / size  # that of the Rayleigh quotient
        if abs(correction) <= 4 * EPS * abs(value):
            break
        value += correction
    return z / math.sqrt(size)


def _space(diag: np.ndarray, low: np.ndarray, values: list[float]) -> np.ndarray:
    """Orthonormal vectors for a cluster of eigenvalues of L D L^T, as columns."""
    x = np.random.default_rng(0).standard_normal((len(diag), len(values)))
    root, last = np.sqrt(diag), len(diag) - 1
    for _ in range(6):
        x, _ = np.linalg.qr(x)
        for j, value in enumerate(values):
            plus, under, _ = _stationary(diag, low, value * (1 + 2 * EPS))
            y = x[:, j].copy()
            for i in range(last):
                y[i + 1] -= under[i] * y[i]
            y /= plus
            for i in range(last - 1, -1, -1):
                y[i] -= under[i] * y[i + 1]
            x[:, j] = y / np.abs(y).max()
    x, _ = np.linalg.qr(x)
    # B x, whose Gram matrix is that of the space.
    image = root[:, None] * x
    image[:-1] += (root[:-1] * low)[:, None] * x[1:]
    _, turn = np.linalg.eigh(image.T @ image)
    return x @ turn[:, ::-1]


def _block(a: np.ndarray, b: np.ndarray, most: int) -> tuple[list[float], np.ndarray]:
    """Squared values of a bidiagonal without zeros above, and vectors of the first ones."""
    diag = a**2
    values = squared_values(diag.tolist(), (b**2).tolist())
    low = b / a[:-1]
    vectors, begin = np.zeros((len(a), 0)), 0
    while begin < min(most, len(values)):
        end = begin + 1
        while end < len(values) and values[end - 1] - values[end] <= CLUSTER * values[end - 1]:
            end += 1
        own = values[begin:end]
        if len(own) == 1:
            found = _twisted(diag, low, own[0])[:, None]
        else:
            found = _space(diag, low, own)
        vectors, begin = np.hstack([vectors, found]), end
    most = min(most, len(values))
    return values, vectors[:, :most]


def right_vectors(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values, largest first, and the right vectors of the first ones as columns."""
    d = len(matrix)
    scale = np.abs(matrix).max() if d else 0.0
    if not scale:
        return np.zeros(d), np.eye(d)[:, : min(most, d)]
    a, b, rights = bidiagonalise(matrix / scale)
    size = max(np.abs(a).max(), np.abs(b).max() if len(b) else 0.0)
    # A zero on the diagonal stands for a value of zero. Both bounds are below the rounding of R.
    a[np.abs(a) < EPS**2 * size] = EPS**2 * size
    b[np.abs(b) < EPS * size] = 0.0
    bounds = [0, *(np.flatnonzero(b == 0) + 1).tolist(), d]
    values, places = [], []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        own, vectors = _block(a[begin:end], b[begin : end - 1], most)
        whole = np.zeros((d, vectors.shape[1]))
        whole[begin:end] = vectors
        values += own
        places += [*whole.T, *[None] * (len(own) - vectors.shape[1])]
    order = sorted(range(d), key=lambda i: -values[i])
    chosen = np.stack([places[i] for i in order[: min(most, d)]], axis=1)
    roots = np.sqrt(np.maximum([values[i] for i in order], 0.0))
    return roots * scale, carry_back(chosen, rights)
