"""Singular values and right singular vectors of a small triangular matrix.

Householder reflections make it bidiagonal, differential quotient-difference steps with shifts (dqds)
give the squares of the singular values to high relative accuracy, and twisted factorisations of
the tridiagonal matrix of the squares give a vector for each.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: Eigenvalues nearer to each other than this share are a cluster, whose vectors are made orthogonal.
CLUSTER = 1e-3
MOST_STEPS = 200


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right factor ``p`` of ``r = u b p'``."""
    a, n = np.array(r, float), r.shape[1]
    p = np.eye(n)

    def reflector(x):
        v, norm = x.copy(), np.linalg.norm(x)
        if norm == 0:
            return None
        v[0] += np.copysign(norm, v[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v = reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """A dqds transform and its intermediate ``d``; None if the shift exceeds the smallest eigenvalue."""
    d = q[0] - shift
    new_q, new_e, ds = [], [], [d]
    for k in range(len(e)):
        if not d >= 0:
            return None
        x = d + e[k]
        t = q[k + 1] / x if x else 0.0
        new_q.append(x)
        new_e.append(e[k] * t)
        d = d * t - shift
        ds.append(d)
    if not d >= 0:
        return None
    return [*new_q, d], new_e, ds


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, falling.

    A step without a shift bounds the smallest eigenvalue from both sides: the least ``d`` above,
    the reciprocal of the sum of all ``1 / d`` below. Shifts between the bounds are tried from above.
    """
    top = float(max([*np.abs(a), *np.abs(b)], default=0.0)) or 1.0
    found, todo = [], [([(x / top) ** 2 for x in a.tolist()], [(x / top) ** 2 for x in b.tolist()], 0.0)]
    while todo:
        q, e, moved = todo.pop()
        for _ in range(MOST_STEPS * (len(q) + 1)):
            while q and (len(q) == 1 or e[-1] <= EPS * EPS * (moved + q[-1])):
                found.append(moved + q.pop())
                e = e[: max(len(q) - 1, 0)]
            if not q:
                break
            cut = next((k for k in range(len(e)) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, ds = _step(q, e, 0.0)
            above = min(ds)
            below = (1 - 4 * len(q) * EPS) / sum(1 / d for d in ds) if above > 0 else 0.0
            for shift in (0.25 * below + 0.75 * above, 0.5 * (below + above), below, 0.5 * below):
                done = _step(q, e, shift) if shift > 0 else None
                if done is not None:
                    q, e, moved = done[0], done[1], moved + shift
                    break
        else:
            raise ArithmeticError("the singular values don't converge")
    return np.sort(np.array(found))[::-1] * top * top


class _Twisted:
    """The twisted factorisation of ``l d l' - x`` at the place where its pivot is smallest."""

    def __init__(self, d: np.ndarray, low: np.ndarray, x: float):
        n, tiny = len(d), EPS * float(np.abs(d).max()) * EPS or np.finfo(float).tiny
        s, p = np.empty(n), np.empty(n)
        self.down, self.up = np.empty(n - 1), np.empty(n - 1)
        upper, lower = np.empty(n), np.empty(n)
        s[0] = -x
        for i in range(n - 1):
            upper[i] = s[i] + d[i] or tiny
            self.down[i] = d[i] * low[i] / upper[i]
            s[i + 1] = self.down[i] * low[i] * s[i] - x
        p[n - 1] = d[n - 1] - x
        for i in range(n - 2, -1, -1):
            lower[i + 1] = d[i] * low[i] ** 2 + p[i + 1] or tiny
            t = d[i] / lower[i + 1]
            self.up[i] = low[i] * t
            p[i] = p[i + 1] * t - x
        pivots = s + p + x
        self.at = r = int(np.argmin(np.abs(pivots)))
        self.pivots = np.concatenate([upper[:r], [pivots[r] or tiny], lower[r + 1 :]])

    def _back(self, z: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z / np.linalg.norm(z)

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.pivots))
        z[self.at] = 1
        return self._back(z)

    def solved(self, y: np.ndarray) -> np.ndarray:
        """A unit vector along the solution for the right side ``y``."""
        y, r = y.copy(), self.at
        for i in range(r):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 2, r - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        z = y / self.pivots
        return self._back(z / np.abs(z).max())


def _apart(z: np.ndarray, near: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The unit vector of ``z`` without its part along ``near``; of a random one if little else is left."""
    while True:
        left = z - near @ (near.T @ z)
        if np.linalg.norm(left) > 1e-3 * np.linalg.norm(z):
            left -= near @ (near.T @ left)
            return left / np.linalg.norm(left)
        z = rng.normal(size=len(z))


def _vectors(diagonal: np.ndarray, low: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of ``l d l'`` for its eigenvalues, falling, as columns."""
    rng, out = np.random.default_rng(3), np.empty((len(diagonal), len(values)))
    first = 0  # of the cluster
    for j, x in enumerate(values):
        if j and values[j - 1] - x > CLUSTER * values[j - 1]:
            first = j
        if len(diagonal) == 1:
            out[:, j] = 1
            continue
        factors = _Twisted(diagonal, low, x)
        z, near = factors.vector(), out[:, first:j]
        if j > first:
            for _ in range(4):
                z = factors.solved(_apart(z, near, rng))
            z = _apart(z, near, rng)
        out[:, j] = z
    return out


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of ``r``, falling, and right singular vectors as columns.

    The tridiagonal matrix of the squares falls into blocks where its upper diagonal is negligible; each
    block has its own values and vectors, so that those of different blocks are orthogonal however near.
    """
    n = r.shape[1]
    a, b, p = bidiagonal(r)
    top = float(max([*np.abs(a), *np.abs(b)], default=0.0))
    if top == 0:
        return np.zeros(n), np.eye(n)
    b[np.abs(b) <= n * EPS * top] = 0
    a[np.abs(a) <= EPS * top] = 0
    values, vectors, start = [], [], 0
    for end in range(1, n + 1):
        if end < n and a[end - 1] * b[end - 1] != 0:
            continue
        carried = b[start - 1] if start else 0.0  # a zero before it leaves its neighbour in this block's first square
        if carried == 0:
            diagonal, low = a[start:end] ** 2, b[start : end - 1] / a[start : end - 1]
            found = squares(a[start:end], b[start : end - 1])
        else:
            extra = np.zeros((end - start + 1, end - start))
            extra[0, 0] = carried
            extra[1:] = np.diag(a[start:end]) + np.diag(b[start : end - 1], 1)
            alpha, beta, _ = bidiagonal(np.linalg.qr(extra, mode="r"))
            found = squares(alpha, beta)
            off = a[start : end - 1] * b[start : end - 1]
            diagonal, low = np.empty(end - start), np.empty(end - start - 1)
            diagonal[0] = a[start] ** 2 + carried**2
            for i in range(end - start - 1):
                low[i] = off[i] / diagonal[i]
                diagonal[i + 1] = a[start + i + 1] ** 2 + b[start + i] ** 2 - low[i] * off[i]
        z = np.zeros((n, end - start))
        z[start:end] = _vectors(diagonal, low, found)
        values.append(found)
        vectors.append(z)
        start = end
    values, vectors = np.concatenate(values), p @ np.concatenate(vectors, axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]
