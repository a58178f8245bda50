"""Eigenpairs of a symmetric matrix in an interval, by contour integration (FEAST).

The spectral projector on the eigenvalues between two numbers is a contour integral of
complex shifted solves (z I - V) Y. Gauss quadrature on the upper half circle applies it to a block of vectors,
Rayleigh-Ritz takes the eigenpairs out of what remains, and this repeats until the residuals
are at rounding. How many eigenvalues must be found is counted beforehand, by the inertia of two
shifted matrices (Sylvester's law), so a missed one is noticed and never passed over.

Everything here works on one p x p matrix; the rows it comes from stay in Spark.
"""

from __future__ import annotations

import numpy as np


def inertia(a: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, zero and negative eigenvalues, by a symmetric elimination with complete
    pivoting over 1 x 1 and 2 x 2 blocks (a 2 x 2 block that is needed holds one of each sign)."""
    a = np.array(a, float)
    tiny = np.abs(a).max(initial=0.0) * len(a) * np.finfo(float).eps
    positive = negative = 0
    while len(a):
        size = np.abs(a)
        r = int(size.diagonal().argmax())
        off = size - np.diag(size.diagonal())
        p, q = divmod(int(off.argmax()), len(a))
        if max(size[r, r], off[p, q]) <= tiny:
            return positive, len(a), negative
        if size[r, r] >= (1 + 17 ** 0.5) / 8 * off[p, q]:
            chosen = [r]
            positive, negative = (positive + 1, negative) if a[r, r] > 0 else (positive, negative + 1)
        else:
            chosen, positive, negative = [p, q], positive + 1, negative + 1
        rest = np.setdiff1d(np.arange(len(a)), chosen)
        side = a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(chosen, chosen)], side.T)
        a = (a + a.T) / 2
    return positive, 0, negative


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``v`` are greater than ``shift``."""
    return inertia(v - shift * np.eye(len(v)))[0]


def eigenvalue_at(v: np.ndarray, j: int, low: float, high: float, steps: int = 60) -> float:
    """The j-th greatest eigenvalue (from 1), by bisection on inertia counts."""
    for _ in range(steps):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        if count_above(v, middle) >= j:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def interval_eigenpairs(v: np.ndarray, low: float, high: float, nodes: int = 12,
                        rounds: int = 40, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``v`` between ``low`` and ``high``, falling, with unit eigenvectors as columns.

    The ends must not be eigenvalues. Raises ArithmeticError if the pairs found are not as many as
    the inertia counts of both ends say.
    """
    p = len(v)
    wanted = count_above(v, low) - count_above(v, high)
    if not wanted:
        return np.zeros(0), np.zeros((p, 0))
    x, weights = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(1j * np.pi / 2 * (1 + x))
    middle, radius = (low + high) / 2, (high - low) / 2
    scale = np.abs(v).sum(axis=1).max()
    width = min(p, wanted + max(4, wanted // 2))
    block = np.random.default_rng(seed).standard_normal((p, width))
    best, found = np.inf, None
    for _ in range(rounds):
        projected = np.zeros((p, block.shape[1]))
        for w, t in zip(weights, turn):
            solved = np.linalg.solve((middle + radius * t) * np.eye(p) - v, block.astype(complex))
            projected += (w / 2 * radius * t * solved).real
        basis = np.linalg.qr(projected)[0]
        values, small = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz in the projected space
        block = basis @ small
        inside = (values > low) & (values < high)
        pairs = values[inside][::-1], block[:, inside][:, ::-1]
        residual = np.abs(v @ pairs[1] - pairs[1] * pairs[0]).max(initial=0.0)
        if len(pairs[0]) == wanted:
            if residual >= best / 2 and best <= 1e-11 * scale:  # at rounding: another round gains nothing
                break
            if residual < best:
                best, found = residual, pairs
        elif width < p:  # too narrow a block: widen it
            width = min(p, width + wanted)
            block = np.hstack([block, np.random.default_rng(seed + width).standard_normal((p, width - block.shape[1]))])
    if found is None or best > 1e-9 * scale:
        raise ArithmeticError(f"{wanted} eigenvalues lie between {low} and {high}; not all of them were found")
    return found


def greatest_eigenpairs(v: np.ndarray, k: int, floor: float = 1e-12) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues above ``floor`` times the greatest one, falling, and unit eigenvectors.

    The lower end of the interval is put into the gap below the k-th one; equal eigenvalues at that
    place are all computed, then cut at ``k``.
    """
    p = len(v)
    bound = np.abs(v).sum(axis=1).max(initial=0.0)
    if not bound:
        return np.zeros(0), np.zeros((p, 0))
    top = eigenvalue_at(v, 1, 0.0, 2 * bound)
    k = min(k, count_above(v, floor * top))
    last = eigenvalue_at(v, k, 0.0, 2 * bound)
    while True:  # the first gap at or below the k-th eigenvalue
        above = count_above(v, last - 1e-9 * top)
        after = eigenvalue_at(v, above + 1, -bound, last) if above < p else -bound / 4
        if last - after > 4e-9 * top:
            break
        last = after
    values, vectors = interval_eigenpairs(v, (last + max(after, -bound / 4)) / 2, 1.5 * bound)
    return values[:k], vectors[:, :k]
