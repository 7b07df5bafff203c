"""Singular values and right singular vectors of a small dense matrix, by way of its bidiagonal form.

Householder reflections reduce the matrix to an upper bidiagonal B; differential qd with shifts (dqds) finds the
eigenvalues of BᵀB without ever forming it; twisted factorisations of BᵀB - λI give one vector for each of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

EPS = float(np.finfo(np.float64).eps)
# b² relative to a² below which a bidiagonal splits: changes singular values by some units in the last place
NEGLIGIBLE = (10 * EPS) ** 2
# eigenvalues closer than this, relatively, are kept orthogonal to each other explicitly
CLUSTER = 1e-3
STEPS_PER_VALUE = 80


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and β such that (I - β v vᵀ) x is a multiple of the first unit vector."""
    norm = float(np.linalg.norm(x))
    if norm == 0:
        return x, 0.0
    v = x.copy()
    v[0] += math.copysign(norm, x[0])
    return v, 2.0 / float(v @ v)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of a square matrix, where UᵀAV is upper bidiagonal."""
    a = np.array(matrix, np.float64)
    n = len(a)
    right = np.eye(n)
    for k in range(n):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= beta * np.outer(right[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def _safe_shift(q: Sequence[float], e: Sequence[float]) -> float:
    """Laguerre's lower bound of the least eigenvalue, from the traces of the inverse and of its square.

    Both come from the qd array by sums of positive terms, so they are accurate to the last places.
    """
    n, c, t = len(q), 0.0, 0.0
    first = second = 0.0
    before = 0.0
    for k, x in enumerate(q):
        if x <= 0:
            return 0.0
        c = (1.0 + before * c) / x
        t = c * c + before / x * t
        first += c
        second += 2.0 * t - c * c
        before = e[k] if k < n - 1 else 0.0
    if not math.isfinite(second):
        return 0.0
    return n / (first + math.sqrt(max((n - 1) * (n * second - first * first), 0.0)))


def _dqds_step(q: Sequence[float], e: Sequence[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One shifted differential qd transform, or none where the shift passed the least eigenvalue."""
    d = q[0] - shift
    if d < 0:
        return None
    new_q, new_e = [], []
    for link, x in zip(e, q[1:]):
        pivot = d + link
        new_q.append(pivot)
        if pivot == 0:  # a zero row: the rest stands alone
            new_e.append(0.0)
            d = x - shift
        else:
            ratio = x / pivot
            new_e.append(link * ratio)
            d = d * ratio - shift
        if d < 0:
            return None
    new_q.append(d)
    return new_q, new_e


def eigenvalues(q: Sequence[float], e: Sequence[float]) -> list[float]:
    """Eigenvalues of BᵀB, largest first, from the squared diagonal and superdiagonal of B, by dqds."""
    found: list[float] = []
    parts = [(list(q), list(e), 0.0)]
    budget = STEPS_PER_VALUE * (len(q) + 1)
    while parts:
        q, e, shifted = parts.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= NEGLIGIBLE * (shifted + min(q[i], q[i + 1]))), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # the small end last
                q, e = q[::-1], e[::-1]
            bound = _safe_shift(q, e)
            for share in (1 - 1e-14, 1 - 1e-8, 0.9, 0.25, 0.0):
                stepped = _dqds_step(q, e, share * bound)
                if stepped is not None:
                    break
            q, e = stepped
            shifted += share * bound
            budget -= 1
            if budget < 0:
                raise RuntimeError("the singular values did not converge")
        found += [x + shifted for x in q]
    return sorted(found, reverse=True)


class _Twisted:
    """The factorisation N Δ Nᵀ of BᵀB - λI that meets in the row of least pivot."""

    def __init__(self, a: Sequence[float], b: Sequence[float], value: float):
        n = len(a)
        tiny = EPS * EPS * max(max(x * x for x in a), value, np.finfo(float).tiny)
        guarded = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
        q = [x * x for x in a]
        s, self.down, self.lower = [-value], [], []
        for i in range(n - 1):
            pivot = guarded(s[i] + q[i])
            self.down.append(pivot)
            self.lower.append(a[i] * b[i] / pivot)
            s.append(b[i] * b[i] * (s[i] / pivot) - value)
        p, self.up, self.upper = [0.0] * n, [0.0] * n, [0.0] * max(n - 1, 0)
        p[-1] = q[-1] - value
        for i in range(n - 2, -1, -1):
            pivot = guarded(b[i] * b[i] + p[i + 1])
            self.up[i + 1] = pivot
            self.upper[i] = a[i] * b[i] / pivot
            p[i] = p[i + 1] * (q[i] / pivot) - value
        pivots = [x + y + value for x, y in zip(s, p)]
        self.at = min(range(n), key=lambda i: abs(pivots[i]))
        self.pivot = guarded(pivots[self.at])

    def _back(self, z: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.lower[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.upper[i] * z[i]
        return z

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.up))
        z[self.at] = 1.0
        return self._back(z)

    def solve(self, x: np.ndarray) -> np.ndarray:
        z, r, n = np.array(x, np.float64), self.at, len(x)
        for i in range(r):
            z[i + 1] -= self.lower[i] * z[i]
        for i in range(n - 2, r - 1, -1):
            z[i] -= self.upper[i] * z[i + 1]
        for i in range(n):
            z[i] /= self.down[i] if i < r else self.pivot if i == r else self.up[i]
        return self._back(z)


def _block_vectors(a: Sequence[float], b: Sequence[float], values: Sequence[float]) -> list[np.ndarray]:
    """Unit eigenvectors of BᵀB of one unreduced B for its first eigenvalues, largest first."""
    out: list[np.ndarray] = []
    start = 0
    draw = np.random.default_rng(len(a))
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * values[k - 1]:
            start = k
        twisted = _Twisted(a, b, value)
        z = twisted.vector()
        z /= np.linalg.norm(z)
        close = out[start:k]
        left = z - sum(((v @ z) * v for v in close), np.zeros(len(z)))
        if close and np.linalg.norm(left) < 0.9:  # the same vector again: another one of its eigenspace
            left = draw.standard_normal(len(z))
        for _ in range(3 if close else 0):
            for _ in range(2):
                left -= sum(((v @ left) * v for v in close), np.zeros(len(z)))
                left /= np.linalg.norm(left)
            left = twisted.solve(left)
            left /= np.linalg.norm(left)
        for _ in range(2 if close else 0):
            left -= sum(((v @ left) * v for v in close), np.zeros(len(z)))
            left /= np.linalg.norm(left)
        out.append(left)
    return out


def right_singular(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest squared singular values of a square matrix, and their right singular vectors as rows."""
    n = len(matrix)
    scale = float(np.abs(matrix).max()) if n else 0.0
    k = min(k, n)
    if scale == 0:
        return np.zeros(k), np.eye(n)[:k]
    diagonal, above, right = bidiagonalise(matrix / scale)
    q, e = diagonal**2, above**2
    cuts = np.flatnonzero(e <= NEGLIGIBLE * (q[:-1] + q[1:])) + 1
    blocks = list(zip([0, *cuts.tolist()], [*cuts.tolist(), n]))
    values = [eigenvalues(q[i:j].tolist(), e[i : j - 1].tolist()) for i, j in blocks]
    chosen = sorted(((-x, block) for block, found in enumerate(values) for x in found))[:k]
    vectors = {}
    for block, (i, j) in enumerate(blocks):
        wanted = sum(1 for _, of in chosen if of == block)
        found = _block_vectors(diagonal[i:j].tolist(), above[i : j - 1].tolist(), values[block][:wanted])
        vectors[block] = iter([np.concatenate([np.zeros(i), z, np.zeros(n - j)]) for z in found])
    rows = np.array([next(vectors[block]) for _, block in chosen])
    return np.array([-x for x, _ in chosen]) * scale**2, rows @ right.T
