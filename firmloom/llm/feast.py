"""The largest eigenpairs of a symmetric matrix by contour integration.

The number of eigenvalues above a shift is the number of positive pivots of the shifted
matrix's factorisation (Sylvester's law of inertia), so bisection finds an interval that holds
the wanted ones and no others. The resolvent, integrated on a circle around the interval, is the
projector onto its eigenvectors: a quadrature of complex shifted solves applies it to a block of
vectors, Rayleigh-Ritz takes eigenpairs out of the result, and both are repeated until the
residuals are down to rounding. The inertia counts then have to agree with what was found.

All matrices are as wide as a vector, whatever the number of rows behind them.
"""

from __future__ import annotations

import numpy as np


def positive_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues are above 0, from L D L' with pivots of one or two rows."""
    a = np.array(matrix, dtype=np.float64)
    grow = (1 + 17**0.5) / 8
    found = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        one = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[one] == 0 and off[i, j] == 0:
            break
        if len(a) == 1 or diagonal[one] >= grow * off[i, j]:
            rest = np.delete(np.arange(len(a)), one)
            found += a[one, one] > 0
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, one], a[rest, one] / a[one, one])
        else:
            # such a pair of rows has one positive and one negative eigenvalue
            pair, rest = [i, j], np.delete(np.arange(len(a)), [i, j])
            found += 1
            a = a[np.ix_(rest, rest)] - a[np.ix_(rest, pair)] @ np.linalg.solve(a[np.ix_(pair, pair)], a[np.ix_(pair, rest)])
    return int(found)


def count_above(matrix: np.ndarray, shift: float) -> int:
    return positive_pivots(matrix - shift * np.eye(len(matrix)))


def _tolerance(matrix: np.ndarray) -> float:
    """What rounding may move an eigenvalue by, with room."""
    return 32 * len(matrix) * np.finfo(float).eps * float(np.abs(matrix).sum(axis=1).max())


def lower_end(matrix: np.ndarray, k: int, high: float) -> float:
    """A shift below the `k` largest eigenvalues: in the middle of the gap under the k-th, or, where
    further ones are equal to it within rounding, below those, too."""
    wide = _tolerance(matrix)

    def edge(count: int) -> tuple[float, float]:
        """Two ends, close together, between which the number above falls from `count` or more to fewer."""
        a, b = -high, high
        while b - a > wide:
            middle = (a + b) / 2
            a, b = (middle, b) if count_above(matrix, middle) >= count else (a, middle)
        return a, b

    low = edge(k)[0]
    if k < len(matrix):
        under = edge(k + 1)[1]
        if low - under > 2 * wide:
            return (low + under) / 2
    return low - 2 * wide


def intervals(matrix: np.ndarray, low: float, high: float) -> list[tuple[float, float, int]]:
    """[low, high] cut where no eigenvalue is near, so that no interval spans much more than a factor
    of four: (low, high, eigenvalues inside), the highest first, empty ones left out."""
    cuts = [high]
    while 0 < 4 * low < cuts[-1]:
        cut = cuts[-1] / 4
        while cut > low and count_above(matrix, cut * 0.999) != count_above(matrix, cut * 1.001):
            cut *= 0.95
        cuts.append(max(cut, low))
    if cuts[-1] > low:
        cuts.append(low)
    counts = [count_above(matrix, c) for c in cuts]
    return [(b, a, n - m) for a, b, m, n in zip(cuts, cuts[1:], counts, counts[1:]) if n > m]


def project(matrix: np.ndarray, low: float, high: float, count: int, nodes: int = 12) -> np.ndarray:
    """Orthonormal eigenvectors of the `count` eigenvalues in (low, high].

    Each round integrates the resolvent, applied to the last round's vectors, around the interval
    and takes Rayleigh-Ritz pairs. Where that settles slowly, as eigenvalues just outside are not
    told apart, the block of vectors is doubled; as wide as the matrix it leaves nothing out.
    """
    size, wide = len(matrix), _tolerance(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    # Gauss-Legendre points on the upper half circle; the lower half is its mirror image
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(1j * np.pi / 2 * (points + 1))
    solvers = [np.linalg.inv((centre + radius * z) * np.eye(size) - matrix) for z in turn]
    filtered = sum(w / 2 * radius * (z * s).real for z, w, s in zip(turn, weights, solvers))
    draw = np.random.default_rng(7)
    block = draw.standard_normal((size, min(size, 2 * count + 4)))
    for turn_no in range(1, 1000):
        basis, _ = np.linalg.qr(filtered @ block)
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ inner
        inside = (values > low) & (values <= high)
        found = block[:, inside]
        worst = np.abs(matrix @ found - found * values[inside]).max(initial=0)
        if inside.sum() == count and worst <= wide / 4:
            return found
        if block.shape[1] == size and inside.sum() == count:
            return found
        if turn_no % 8 == 0:
            more = min(size, 2 * block.shape[1]) - block.shape[1]
            block = np.column_stack([block, draw.standard_normal((size, more))])
    raise ArithmeticError(f"{int(inside.sum())} eigenvalues found of {count} counted between {low} and {high}")


def top_eigenpairs(matrix: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """The `k` largest eigenvalues above `floor`, falling, and their unit eigenvectors as columns.

    Fewer where fewer are above it; an empty matrix has none. Raises where the inertia counts and
    the pairs found disagree.
    """
    size = len(matrix)
    scale = float(np.abs(matrix).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((size, 0))
    a = (matrix + matrix.T) / (2 * scale)
    wide = _tolerance(a)
    floor = max(floor / scale, wide)
    k = min(k, count_above(a, floor))
    if not k:
        return np.zeros(0), np.zeros((size, 0))
    high = float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9)
    low = max(lower_end(a, k, high), floor)
    parts = [project(a, *part) for part in intervals(a, low, high)]
    basis, _ = np.linalg.qr(np.column_stack(parts))
    values, inner = np.linalg.eigh(basis.T @ a @ basis)
    values, vectors = values[::-1][:k], (basis @ inner)[:, ::-1][:, :k]
    for n, value in enumerate(values, 1):
        if not count_above(a, value + wide) < n <= count_above(a, value - wide):
            raise ArithmeticError(f"the inertia count does not confirm eigenvalue {n}")
    return values * scale, vectors
