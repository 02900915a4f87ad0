"""Eigenvalues and eigenvectors of a scatter matrix that grows by one vector at a time."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
# Rounds that a root of the secular equation may take; a handful is usual.
_ROUNDS = 80


def _joined(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, tol: float) -> None:
    """Within equal values, turn the vectors so that only the last has a part in ``z``."""
    equal = np.diff(values) <= tol
    if not equal.any():
        return
    ends = np.flatnonzero(np.concatenate((~equal, [True]))) + 1
    start = 0
    for end in ends:
        part = z[start:end].copy()
        norm = float(np.sqrt(part @ part))
        if end - start > 1 and norm > 0 and np.count_nonzero(part[:-1]):
            mirror = part.copy()
            mirror[-1] += norm if part[-1] >= 0 else -norm
            block = vectors[:, start:end]
            block -= np.outer(block @ mirror, mirror * (2 / (mirror @ mirror)))
            z[start:end] = 0
            z[end - 1] = -norm if part[-1] >= 0 else norm
        start = end


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + sum z_j**2 / (d_j - x) = 0``; ``d`` ascends strictly, no ``z`` is 0.

    Root i lies between ``d[i]`` and the next (the last one within ``z @ z`` above). It is sought
    as a distance from the nearer pole, so that differences to the poles keep their digits.
    Returns the roots and the matrix ``root_i - d_j``.
    """
    m, squares = len(d), z * z
    rows = np.arange(m)
    gap = np.append(np.diff(d), squares.sum())
    shifted = d[None, :] - d[:, None]
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        middle = 1 + (squares / (shifted - gap[:, None] / 2)).sum(axis=1)
        right = (middle < 0) & (rows < m - 1)
        origin = np.where(right, rows + 1, rows)
        poles = d[None, :] - d[origin][:, None]
        low = np.where(right, -gap / 2, 0.0)
        high = np.where(right, 0.0, np.where(rows < m - 1, gap / 2, gap))
        # Besides the nearest pole, one more is kept in the model, and the others' slope goes with it.
        second = np.where(right, rows, np.minimum(rows + 1, m - 1))
        second[m - 1] = max(m - 2, 0)
        p, s = poles[rows, second], squares[origin]
        x = (low + high) / 2
        open_ = rows
        for _ in range(_ROUNDS):
            at, own_pole, own_p, own_s = x[open_], origin[open_], p[open_], s[open_]
            terms = squares / (poles[open_] - at[:, None])
            value = 1 + terms.sum(axis=1)
            # Rounding of the sum hides the rest.
            going = np.abs(value) > 4 * _EPS * (1 + np.abs(terms).sum(axis=1))
            if not going.any():
                break
            open_, at, own_pole, own_p, own_s = (v[going] for v in (open_, at, own_pole, own_p, own_s))
            terms, value = terms[going], value[going]
            low[open_], high[open_] = np.where(value < 0, at, low[open_]), np.where(value < 0, high[open_], at)
            here = np.arange(len(open_))
            own = terms[here, own_pole]
            slopes = terms * terms / squares
            rest, slope = value - own, slopes.sum(axis=1) - slopes[here, own_pole]
            away = own_p - at
            a, b = rest - slope * away, slope * away * away
            half = (a * own_p + own_s + b) / 2
            root = np.sqrt(np.maximum(half * half - a * own_s * own_p, 0))
            q = half + np.where(half >= 0, root, -root)
            first, other = own_s * own_p / q, q / a
            least, most = low[open_], high[open_]
            new = np.where((first > least) & (first < most), first, other)
            x[open_] = np.where((new > least) & (new < most), new, (least + most) / 2)
    return d[origin] + x, x[:, None] - poles


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors (columns) after ``v v'`` is added.

    What has no part in ``v``, or an eigenvalue equal to another's, is deflated and stays. The
    others move to the roots of the secular equation; their vectors come from the ``z`` for
    which these roots are exact, so that they stay orthogonal.
    """
    z = vectors.T @ v
    size = float(z @ z)
    scale = max(float(values[-1]), size)
    if size <= _EPS * _EPS * scale or scale == 0:
        return values, vectors
    tol = 8 * _EPS * scale
    vectors = vectors.copy()
    _joined(values, vectors, z, tol)
    moved = np.flatnonzero(np.abs(z) * np.sqrt(size) > tol)
    if not len(moved):
        return values, vectors
    d, part = values[moved], z[moved]
    roots, apart = secular_roots(d, part)
    m = len(d)
    i, j = np.arange(m)[:, None], np.arange(m)[None, :]
    following = np.append(d[1:], 0.0)
    by = np.where(i < j, d[:, None] - d[None, :], following[:, None] - d[None, :])
    by[m - 1] = 1.0
    fitted = np.sqrt(np.abs(np.prod(apart / by, axis=0))) * np.sign(part)
    turned = (fitted[None, :] / -apart).T
    turned /= np.sqrt((turned * turned).sum(axis=0))
    vectors[:, moved] = vectors[:, moved] @ turned
    values = values.copy()
    values[moved] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number and sums of vectors, and the spectrum of their scatter around their mean."""

    def __init__(self, width: int):
        self.n, self.sums = 0, np.zeros(width, np.int64)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, x: np.ndarray) -> None:
        """One vector of whole numbers: a rank-one update by its distance from the mean."""
        if self.n:
            away = (x - self.sums / self.n) * np.sqrt(self.n / (self.n + 1))
            self.values, self.vectors = rank_one(self.values, self.vectors, away)
        self.n, self.sums = self.n + 1, self.sums + x

    def merge(self, other: Spectrum) -> None:
        """The scatter of both: a rank-one update per eigenvector of ``other``, and one for the means."""
        if self.n and other.n:
            away = self.sums / self.n - other.sums / other.n
            away *= np.sqrt(self.n / (self.n + other.n) * other.n)
            self.values, self.vectors = rank_one(self.values, self.vectors, away)
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector * np.sqrt(value))
        self.n, self.sums = self.n + other.n, self.sums + other.sums
