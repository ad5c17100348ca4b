"""Eigenpairs of a symmetric matrix kept up to date under rank-one changes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(float).eps)
ROUNDS = 60


def roots(d: np.ndarray, z: np.ndarray, weight: float) -> np.ndarray:
    """Differences ``d[j] - root[i]`` (row i) for the roots of 1 + weight * sum z^2 / (d - x).

    ``d`` ascends strictly, no z is 0, weight > 0: root i lies between d[i] and d[i + 1],
    the last one below d[-1] + weight * |z|^2. A root is kept as its distance to the
    nearer pole, so that differences are exact however close it lies. Each step
    solves for two poles with the function's value and slopes on both sides, and
    falls back to bisection where that leaves the bracket.
    """
    m, z2 = len(d), weight * z * z
    reach = float(z2.sum())
    ends = np.append(d[1:], d[-1] + reach)
    half = (ends - d) / 2
    at_half = 1 + (z2 / (d[None, :] - d[:, None] - half[:, None])).sum(axis=1)
    lower = (at_half >= 0) | (np.arange(m) == m - 1)
    origin = np.where(lower, d, ends)
    low = np.where(lower, 0.0, -half)
    high = np.where(lower, half, 0.0)
    high[-1] = reach
    own, following = d - origin, np.append(d[1:], d[-1] + 2 * reach) - origin
    poles = d[None, :] - origin[:, None]
    left = np.tri(m, dtype=bool)
    x = (low + high) / 2
    for _ in range(ROUNDS):
        gap = poles - x[:, None]
        terms = z2 / gap
        slopes = terms / gap
        f = 1 + terms.sum(axis=1)
        done = np.abs(f) <= 4 * m * EPS * (1 + np.abs(terms).sum(axis=1))
        if done.all():
            break
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        before = (slopes * left).sum(axis=1)
        after = slopes.sum(axis=1) - before
        p, q = own - x, following - x
        a = (p + q) * f - p * q * (before + after)
        b = p * q * f
        c = f - p * before - q * after
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
            inside = (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    return poles - x[:, None]


def _vectors(d: np.ndarray, z: np.ndarray, weight: float, gap: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors (columns) for the roots found, by the vector they are exact for."""
    m = len(d)
    apart = d[:, None] - d[None, :]
    ahead = np.vstack([apart[1:], np.full((1, m), weight)])
    below = np.arange(m)[:, None] < np.arange(m)[None, :]
    exact = np.sqrt(np.abs((-gap / np.where(below, apart, ahead)).prod(axis=0)))
    vectors = (np.copysign(exact, z)[None, :] / gap).T
    return vectors / np.sqrt((vectors * vectors).sum(axis=0))


def rank_one(values: np.ndarray, vectors: np.ndarray, change: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs, ascending, after ``weight * change change'`` is added.

    Deflation: within a run of equal values the basis is reflected so that only one
    vector has a share in the change; vectors without a share keep their pair.
    """
    z = vectors.T @ change
    size = weight * float(z @ z)
    if not size > 0:
        return values, vectors
    limit = 8 * EPS * max(float(values[-1]), size)
    vectors = vectors.copy()
    edges = np.flatnonzero(np.diff(values) > limit) + 1
    first, beyond = np.concatenate([[0], edges]), np.concatenate([edges, [len(values)]])
    several = beyond - first > 1
    for a, b in zip(first[several], beyond[several]):
        if (norm := float(np.linalg.norm(z[a:b]))) > 0:
            mirror = z[a:b].copy()
            mirror[-1] += np.copysign(norm, mirror[-1])
            mirror /= np.linalg.norm(mirror)
            vectors[:, a:b] -= 2 * np.outer(vectors[:, a:b] @ mirror, mirror)
            z[b - 1] = -np.copysign(norm, z[b - 1])
            z[a : b - 1] = 0
    live = np.flatnonzero(weight * np.abs(z) * np.sqrt(size / weight) > limit)
    if not len(live):
        return values, vectors
    d, values = values[live], values.copy()
    gap = roots(d, z[live], weight)
    # the root by its nearer pole
    nearest = np.abs(gap).argmin(axis=1)
    values[live] = d[nearest] - gap[np.arange(len(d)), nearest]
    vectors[:, live] = vectors[:, live] @ _vectors(d, z[live], weight, gap)
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Eigenpairs of the scatter of the rows seen so far about their mean."""

    rows: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, row: np.ndarray) -> None:
        off = row - self.mean
        if self.rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.rows / (self.rows + 1))
        self.rows += 1
        self.mean = self.mean + off / self.rows

    def join(self, other: Spectrum) -> None:
        """Add another spectrum: its eigenpairs one by one, and the distance of the means."""
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        off, rows = other.mean - self.mean, self.rows + other.rows
        if rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.rows * other.rows / rows)
            self.mean = self.mean + off * (other.rows / rows)
        self.rows = rows
