"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation,
bisection on Sturm counts, inverse iteration.

The matrix is small (one row per dimension) and held in memory; time is cubic
and memory quadratic in its size.  Results are deterministic.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
# eigenvalues closer than this share of the norm are reorthogonalised together
CLUSTER = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, Q) with ``a = Q T Q'``, by reflections."""
    a = a.copy()
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        scale = np.abs(x).max()
        if scale == 0.0 or not np.abs(x[1:]).any():
            continue
        v = x / scale
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2.0 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2.0 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= np.outer(2.0 * (q[:, k + 1 :] @ v), v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each value of ``at``: the negative pivots
    of ``T - at I``."""
    tiny = EPS * EPS * max(float(np.abs(diag).max()), float(np.abs(off).max()) if len(off) else 0.0, 1e-290)
    square = off * off
    pivot = diag[0] - at
    count = (pivot < 0).astype(np.int64)
    for i in range(1, len(diag)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diag[i] - at - square[i - 1] / pivot
        count += pivot < 0
    return count


def leading_values(diag: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` greatest eigenvalues, falling, bisected all at once until
    their intervals hold no further double."""
    n = len(diag)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = (diag - reach).min(), (diag + reach).max()
    pad = 2.0 * EPS * n * max(abs(low), abs(high)) + 1e-300
    rank = n - 1 - np.arange(count)  # eigenvalues below the sought one
    lo, hi = np.full(count, low - pad), np.full(count, high + pad)
    while True:
        mid = lo + (hi - lo) / 2.0
        open_ = (mid > lo) & (mid < hi)
        if not open_.any():
            return lo + (hi - lo) / 2.0
        below = sturm_counts(diag, off, mid) <= rank
        lo = np.where(open_ & below, mid, lo)
        hi = np.where(open_ & ~below, mid, hi)


def _factor(diag: np.ndarray, off: np.ndarray, value: float, floor: float):
    """LU of ``T - value I`` with row exchanges; zero pivots become ``floor``."""
    n = len(diag)
    d, u, u2 = list(diag - value), [*off, 0.0], [0.0] * n
    mult, swap = [0.0] * n, [False] * n
    for i in range(n - 1):
        sub = float(off[i])
        if abs(d[i]) >= abs(sub):
            d[i] = d[i] if d[i] != 0.0 else floor
            mult[i] = sub / d[i]
            d[i + 1] -= mult[i] * u[i]
        else:
            swap[i] = True
            mult[i] = d[i] / sub
            d[i], u[i], d[i + 1], u2[i], u[i + 1] = (
                sub, d[i + 1], u[i] - mult[i] * d[i + 1], u[i + 1], -mult[i] * u[i + 1])
    d[n - 1] = d[n - 1] if abs(d[n - 1]) > floor else floor
    return d, u, u2, mult, swap


def _solve(factors, b: np.ndarray) -> np.ndarray:
    d, u, u2, mult, swap = factors
    x, n = list(b), len(d)
    for i in range(n - 1):
        if swap[i]:
            x[i], x[i + 1] = x[i + 1], x[i]
        x[i + 1] -= mult[i] * x[i]
    for i in range(n - 1, -1, -1):
        s = x[i]
        if i + 1 < n:
            s -= u[i] * x[i + 1]
        if i + 2 < n:
            s -= u2[i] * x[i + 2]
        x[i] = s / d[i]
    return np.array(x)


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the falling ``values``; each is kept
    orthogonal to those of its cluster while it is iterated."""
    n = len(diag)
    norm = float((np.abs(diag) + np.append(np.abs(off), 0.0) + np.append(0.0, np.abs(off))).max())
    out = np.zeros((n, len(values)))
    rng = np.random.default_rng(0)
    first, shift = 0, 0.0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        # equal values get shifts of their own, or they would give one vector
        step = 10.0 * EPS * max(norm, 1e-290)
        shift = min(float(value), shift - step) if k > first else float(value)
        factors = _factor(diag, off, shift, EPS * max(norm, 1e-290))
        z = rng.standard_normal(n)
        basis = out[:, first:k]
        done = 0
        for _ in range(12):
            z = _solve(factors, z / np.abs(z).max())
            grown = np.abs(z).max()
            z /= grown
            for _ in range(2):
                z -= basis @ (basis.T @ z)
            z /= np.sqrt(z @ z)
            # two more rounds once the solution has grown as far as it can
            done += grown * EPS * n * norm > 1e-3
            if done > 2:
                break
        out[:, k] = z
    return out


def leading_pairs(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues, falling, and their unit vectors as
    columns; in each vector the entry of greatest size is positive."""
    count = min(count, len(a))
    scale = float(np.abs(a).max()) if a.size else 0.0
    if not count or scale == 0.0:
        return np.zeros(count), np.eye(len(a))[:, :count]
    diag, off, q = tridiagonal(a / scale)
    values = leading_values(diag, off, count)
    vectors = q @ inverse_iteration(diag, off, values)
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.where(vectors[top, np.arange(count)] < 0, -1.0, 1.0)
    return values * scale, vectors
