"""Singular values and right singular vectors of a small triangular matrix.

``householder`` brings R to upper bidiagonal form, ``dqds`` finds the squared singular values
by differential quotient-difference steps with shifts, and ``directions`` recovers singular
vectors by twisted factorisations.  All of it works on one d x d matrix (d: the dimension of
the vectors, not the number of rows), so it runs on the driver.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
#: Below this share of the matrix's size a neighbour counts as no gap, and vectors are made orthogonal.
GAP = 1e-3


def householder(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the orthogonal V with UᵀRV bidiagonal, by alternating
    Householder reflections of columns and rows."""
    a = np.array(r, float)
    d = a.shape[0]
    right = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.abs(x[1:]).max(initial=0.0) > 0:
            return None
        v = x / size
        v[0] += math.copysign(float(np.linalg.norm(v)), v[0] or 1.0)
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d:
            v = reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2.0 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transform; also the intermediate d, all positive if the shift was below the least value."""
    n = len(q)
    new_q, new_e, ds = [0.0] * n, [0.0] * (n - 1), [0.0] * n
    d = q[0] - shift
    for k in range(n - 1):
        ds[k] = d
        new_q[k] = d + e[k]
        if new_q[k] == 0.0:  # q and e vanish here: the rest is moved up unchanged
            d = q[k + 1] - shift
            continue
        t = q[k + 1] / new_q[k]
        new_e[k] = e[k] * t
        d = d * t - shift
    ds[n - 1] = new_q[n - 1] = d
    return new_q, new_e, ds


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values, falling.  A shift is the bound 1 / sum(1 / d) of the last
    transform, which never exceeds the least value left; nothing is subtracted otherwise, so
    small values keep their relative accuracy."""
    q0, e0 = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above]
    found: list[float] = []
    blocks = [(q0, e0, 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        for _ in range(1000 + 100 * len(q)):
            n = len(q)
            if n < 2:
                break
            tiny = next((k for k in range(n - 2, -1, -1) if e[k] <= EPS * EPS * (sigma + min(q[k], q[k + 1]))
                         or e[k] <= EPS * EPS * sigma or e[k] < 1e-290), None)
            if tiny == n - 2:
                found.append(sigma + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            if tiny is not None:
                blocks.append((q[: tiny + 1], e[:tiny], sigma))
                q, e = q[tiny + 1 :], e[tiny + 1 :]
                continue
            if n == 2:  # the two values of the last block in closed form
                s, p = q[0] + q[1] + e[0], q[0] * q[1]
                high = (s + math.sqrt(max(0.0, (q[0] - q[1] + e[0]) ** 2 + 4.0 * q[1] * e[0]))) / 2.0
                found += [sigma + high, sigma + (p / high if high else 0.0)]
                q, e = [], []
                break
            q, e, ds = _step(q, e, 0.0)
            least = 1.0 / sum(1.0 / d for d in ds) if min(ds) > 0.0 else 0.0
            shift = least * (1.0 - 4.0 * EPS * n)
            while shift > 0.0:
                moved = _step(q, e, shift)
                if min(moved[2]) >= 0.0:
                    q, e, sigma = moved[0], moved[1], sigma + shift
                    break
                shift *= 0.5
                if shift < EPS * least:
                    break
        else:
            raise ArithmeticError("the quotient-difference steps did not converge")
        found += [sigma + x for x in q]
    return np.array(sorted((max(0.0, x) for x in found), reverse=True))


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """The vector of BᵀB at an eigenvalue: the stationary factorisation from above and the
    progressive one from below meet where the residual is least."""
    n = len(diagonal)
    size = max(float(np.abs(diagonal).max()), float(np.abs(above).max(initial=0.0)), 1e-150) ** 2
    guard = EPS * EPS * size

    def safe(x: float) -> float:
        return x if abs(x) > guard else math.copysign(guard, x or 1.0)

    a2, off = diagonal**2, diagonal[:-1] * above
    low, s = np.zeros(n), np.zeros(n)  # stationary: L D Lᵀ of BᵀB, shifted
    s[0] = -value
    for k in range(n - 1):
        top = safe(a2[k] + s[k])
        low[k] = off[k] / top
        s[k + 1] = low[k] * (above[k] / diagonal[k] if diagonal[k] else 0.0) * s[k] - value if diagonal[k] else above[k] ** 2 - value
    up, p = np.zeros(n), np.zeros(n)  # progressive: U R Uᵀ
    p[n - 1] = a2[n - 1] - value
    for k in range(n - 2, -1, -1):
        bottom = safe(above[k] ** 2 + p[k + 1])
        up[k] = off[k] / bottom
        p[k] = a2[k] * (p[k + 1] / bottom) - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Columns: the unit right singular vectors of the given squared singular values (falling).

    Where the superdiagonal vanishes the matrix falls apart, and a vector lies in one block.
    Vectors of values without a gap are made orthogonal to those before; one that nearly
    vanishes by that is found again by inverse iteration in what is left.
    """
    n = len(diagonal)
    size = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(above).max(initial=0.0)), 1e-150)
    ends = [0, *(np.flatnonzero(np.abs(above) <= EPS * size) + 1).tolist(), n]
    spectrum = [(v, lo, hi) for lo, hi in zip(ends[:-1], ends[1:]) for v in dqds(diagonal[lo:hi], above[lo : hi - 1])]
    spectrum.sort(key=lambda x: -x[0])
    whole = np.diag(diagonal) + np.diag(above, 1) if n else np.zeros((0, 0))
    normal = whole.T @ whole
    out = np.zeros((n, len(values)))
    for k, value in enumerate(values):
        own, lo, hi = spectrum[k]
        z = np.zeros(n)
        z[lo:hi] = _twisted(diagonal[lo:hi], above[lo : hi - 1], own)
        near = out[:, [j for j in range(k) if abs(values[j] - value) <= GAP * size**2]]
        left = z - near @ (near.T @ z)
        if np.linalg.norm(left) < 0.5 or np.linalg.norm(normal @ z - value * z) > 1e-10 * size**2:
            left = np.cos(np.arange(1.0, n + 1.0) * (k + 1.0))
            for _ in range(4):
                left -= near @ (near.T @ left)
                left = np.linalg.solve(normal - (value + 4.0 * EPS * size**2 * (k + 1)) * np.eye(n), left / np.linalg.norm(left))
            left /= np.linalg.norm(left)
            left -= near @ (near.T @ left)
        left -= near @ (near.T @ left)
        out[:, k] = left / np.linalg.norm(left)
    return out
