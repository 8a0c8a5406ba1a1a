"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, bisection by Sturm counts, inverse iteration.

The matrix is of one row's width, so it is worked on in one place; everything that grows with the rows is done by Spark.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
CLUSTER = 1e-3  # eigenvalues closer than this part of the matrix' norm are orthogonalised together
_STEPS = 8      # inverse iterations of a vector


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, reflectors): Q' a Q is tridiagonal, Q = H_0 H_1 ..., H_k = 1 - 2 v_k v_k'."""
    a = np.array(a, np.float64)
    n = len(a)
    v = np.zeros((max(n - 2, 0), n))
    for k in range(n - 2):
        x = a[k + 1:, k]
        big = np.abs(x).max()
        if big == 0.0 or not np.abs(x[1:]).max() > 0.0:
            continue  # the column has its form already
        u = x / big
        u[0] += np.copysign(np.sqrt(u @ u), u[0])
        u /= np.sqrt(u @ u)
        v[k, k + 1:] = u
        p = a[:, k + 1:] @ u
        a[:, k + 1:] -= 2.0 * np.outer(p, u)
        q = u @ a[k + 1:]
        a[k + 1:] -= 2.0 * np.outer(u, q)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def sturm_count(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Eigenvalues of the tridiagonal matrix below each ``x``: negative terms of the Sturm sequence."""
    tiny = np.finfo(np.float64).tiny / _EPS * max(1.0, float(np.max(e * e, initial=0.0)))
    q = d[0] - x
    count = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - x - e[i - 1] * e[i - 1] / q
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues in falling order, each by bisection to the last bits."""
    n = len(d)
    reach = np.append(np.abs(e), 0.0) + np.append(0.0, np.abs(e))
    low, high = float((d - reach).min()), float((d + reach).max())
    room = 2 * n * _EPS * max(abs(low), abs(high)) + np.finfo(np.float64).tiny
    wanted = n - 1 - np.arange(k)  # the i-th smallest has i eigenvalues below it
    lo, hi = np.full(k, low - room), np.full(k, high + room)
    while True:
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            return mid
        below = sturm_count(d, e, mid) > wanted
        lo, hi = np.where(below, lo, mid), np.where(below, mid, hi)


def _solver(d: np.ndarray, e: np.ndarray, x: float):
    """Solve (T - x) y = b by elimination with row exchanges; a pivot of zero becomes a rounding error."""
    n = len(d)
    least = _EPS * max(float(np.abs(d).max()), float(np.abs(e).max(initial=0.0)), np.finfo(np.float64).tiny)
    a, b, c = d - x, np.append(e, 0.0), np.zeros(n)  # pivots and the two diagonals above
    low, swap = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        below = e[i]
        if abs(below) > abs(a[i]):
            swap[i] = True
            low[i] = a[i] / below
            a[i], old = below, b[i]
            b[i], c[i] = a[i + 1], b[i + 1]
            a[i + 1], b[i + 1] = old - low[i] * b[i], -low[i] * c[i]
        else:
            a[i] = a[i] if abs(a[i]) > least else np.copysign(least, a[i])
            low[i] = below / a[i]
            a[i + 1] -= low[i] * b[i]
    a[-1] = a[-1] if abs(a[-1]) > least else np.copysign(least, a[-1])

    def solve(y: np.ndarray) -> np.ndarray:
        y = y.copy()
        for i in range(n - 1):
            if swap[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= low[i] * y[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                y[i] -= b[i] * y[i + 1]
            if i + 2 < n:
                y[i] -= c[i] * y[i + 2]
            y[i] /= a[i]
            big = np.abs(y).max()
            if big > 1e150:
                y /= big
        return y

    return solve


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of falling ``values`` by inverse iteration, orthogonal within clusters."""
    n = len(d)
    norm = max(float(np.abs(d).max()) + 2 * float(np.abs(e).max(initial=0.0)), np.finfo(np.float64).tiny)
    out = np.zeros((len(values), n))
    start, last = 0, None
    rng = np.random.default_rng(20)
    for j, value in enumerate(values.tolist()):
        if j and values[j - 1] - value > CLUSTER * norm:
            start, last = j, None
        # equal values are moved apart a little, so their factors differ
        shift = value if last is None or last - value > 4 * _EPS * norm else last - 4 * _EPS * norm
        last = shift
        solve = _solver(d, e, shift)
        y = rng.standard_normal(n)
        for _ in range(_STEPS):
            y = solve(y / np.abs(y).max())
            y /= np.sqrt(y @ y)
            for _ in range(2):  # twice is enough
                y -= out[start:j].T @ (out[start:j] @ y)
                length = np.sqrt(y @ y)
                if length < 1e-8:
                    y = rng.standard_normal(n)
                    length = np.sqrt(y @ y)
                y /= length
        out[j] = y
    return out


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the ``k`` largest eigenvalues of a symmetric matrix."""
    n = len(a)
    k = min(k, n)
    if not k:
        return np.zeros(0), np.zeros((0, n))
    scale = float(np.abs(a).max())
    if scale == 0.0:
        return np.zeros(k), np.eye(n)[:k]
    d, e, v = tridiagonal(np.asarray(a, np.float64) / scale)
    values = leading_eigenvalues(d, e, k)
    y = tridiagonal_vectors(d, e, values)
    for u in v[::-1]:  # back through the reflections
        y -= 2.0 * np.outer(y @ u, u)
    y /= np.sqrt((y * y).sum(axis=1))[:, None]
    return values * scale, y
