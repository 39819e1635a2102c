"""Eigenpairs of a symmetric matrix by contour integration (FEAST), and counts that prove that none is missed.

The counts are inertia: the matrix is made tridiagonal once by reflections, and the number of negative pivots of that less a
shift is the number of eigenvalues below the shift. They cut the spectrum into intervals, in wide gaps and with few eigenvalues
each; equal ones are never parted. An interval's subspace is found by integrating the resolvent, applied to random vectors, along a circle around it: one
complex shifted solve for each point of the quadrature. Rayleigh-Ritz on that subspace gives the pairs; both are repeated until
the residuals are at rounding error, and the interval must then hold as many pairs as inertia counts.
"""

from __future__ import annotations

import numpy as np

NODES, ROUNDS, LEAST, MOST = 8, 60, 4, 12
#: A gap of so small a part of the interval above it is none; rounds after which a subspace that does not settle is widened.
NARROW, PATIENCE = 1e-6, 8
EPS = float(np.finfo(float).eps)


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        if not (size := np.linalg.norm(x)):
            continue
        x /= size
        y = a[k + 1 :, k:].T @ x
        a[k + 1 :, k:] -= 2 * np.outer(x, y)
        y = a[k:, k + 1 :] @ x
        a[k:, k + 1 :] -= 2 * np.outer(y, x)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy()


class Spectrum:
    """Where the eigenvalues of a symmetric matrix are, by inertia."""

    def __init__(self, matrix: np.ndarray):
        self.size = len(matrix)
        self.diagonal, off = tridiagonal(matrix)
        self.squares = off**2
        around = np.zeros(self.size)
        around[:-1] += np.abs(off)
        around[1:] += np.abs(off)
        self.norm = float((np.abs(self.diagonal) + around).max(initial=0))
        self.low, self.high = -self.norm * 1.01 - EPS, self.norm * 1.01 + EPS

    def below(self, shift: float) -> int:
        """The number of eigenvalues below a shift: negative pivots."""
        count, pivot, least = 0, 1.0, EPS * EPS * (self.norm + EPS)
        for k in range(self.size):
            pivot = self.diagonal[k] - shift - (self.squares[k - 1] / pivot if k else 0.0)
            if abs(pivot) < least:
                pivot = -least
            count += pivot < 0
        return int(count)

    def largest(self, k: int) -> float:
        """About the k-th largest eigenvalue, from 1; beyond the last one the lower bound of all."""
        if k > self.size:
            return self.low
        low, high = self.low, self.high
        while high - low > 4 * EPS * self.norm + EPS * EPS:
            middle = (low + high) / 2
            if middle in (low, high):
                break
            if self.size - self.below(middle) >= k:
                low = middle
            else:
                high = middle
        return (low + high) / 2

    def intervals(self, many: int) -> list[tuple[float, float, int]]:
        """Low, high and count of intervals from the largest eigenvalue down, which hold the `many` largest at least.

        Each ends in the widest gap after LEAST to MOST eigenvalues; equal ones are never parted.
        """
        values = {k: self.largest(k) for k in range(1, min(self.size, many + MOST) + 2)}
        found, done, high = [], 0, self.high
        while done < many:
            ends = range(done + min(LEAST, self.size - done), min(done + MOST, self.size) + 1)
            end = max(ends, key=lambda k: values[k] - values.get(k + 1, self.low))
            while end < self.size and values[end] - values.setdefault(end + 1, self.largest(end + 1)) < max(1e3 * EPS * self.norm, NARROW * (high - values[end])):
                end += 1
            values.setdefault(end + 1, self.largest(end + 1))
            # Just outside the last eigenvalue where a wide gap follows: the circle should be no larger than it need be.
            low = max((values[end] + values[end + 1]) / 2, values[end] - (high - values[end]) / 2 - EPS * self.norm) if end < self.size else values[end] - max((high - values[end]) / 2, 1e-3 * self.norm)
            found.append((float(low), float(high), int(self.below(high) - self.below(low))))
            done, high = self.size - self.below(low), low
        return found


def pairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues between low and high, falling, and their unit vectors as columns; count is what inertia says."""
    size = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max(initial=EPS)
    width = min(size, 2 * count + 8)
    vectors = np.random.default_rng(size).standard_normal((size, width))
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(-0.5j * np.pi * (points - 1))
    shifted = [(centre + radius * t) * np.eye(size) - matrix for t in turns]
    best = np.inf
    for k in range(ROUNDS):
        if k % PATIENCE == PATIENCE - 1 and width < size:  # eigenvalues stand close around the circle
            more = np.random.default_rng(k).standard_normal((size, min(width, size - width)))
            vectors, width = np.hstack([vectors, more]), min(2 * width, size)
        space = sum(w / 2 * radius * np.real(t * np.linalg.solve(s, vectors)) for w, t, s in zip(weights, turns, shifted))
        basis, _ = np.linalg.qr(space)
        basis, _ = np.linalg.qr(basis)
        projected = basis.T @ matrix @ basis
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        vectors = basis @ turn
        inside = np.flatnonzero((values > low) & (values < high))
        if len(inside) == count:
            residual = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0).max(initial=0)
            if residual <= 4 * EPS * scale or residual <= 64 * EPS * scale and residual >= best / 2:
                order = inside[::-1]
                return values[order], vectors[:, order]
            best = min(best, residual)
    raise ArithmeticError(f"an interval holds {count} eigenvalues by inertia, {len(inside)} were found")
