"""Leading eigenpairs of one symmetric matrix by contour integration (FEAST).

The matrix is a covariance: its size is the number of dimensions, whatever the number of rows it was gathered from.

1. Slices: inertia counts (signs of the pivots of a symmetric factorisation) place borders in gaps of the spectrum,
   so that it is known how many eigenvalues each slice holds.
2. Per slice: Gauss-Legendre quadrature of shifted solves along a half circle projects a block of vectors
   onto the slice's eigenspace; Rayleigh-Ritz extracts pairs; repeated until the residuals are at rounding level.
3. A slice with another number of pairs than its inertia count is done again with a larger block, up to all of the space.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: the pivot ratio that bounds the growth of a factorisation with blocks of one and two rows
_RATIO = (1 + 17**0.5) / 8


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``, from the pivots of ``matrix - shift * I`` (Sylvester's law of inertia)."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        size = np.abs(a)
        on_diagonal = int(np.argmax(np.diag(size)))
        row, column = np.unravel_index(int(np.argmax(size)), size.shape)
        if size[row, column] == 0:
            break
        if row == column or size[on_diagonal, on_diagonal] >= _RATIO * size[row, column]:
            rest = np.delete(np.arange(len(a)), on_diagonal)
            pivot, edge = a[on_diagonal, on_diagonal], a[rest, on_diagonal]
            above += int(pivot > 0)
            a = a[np.ix_(rest, rest)] - np.outer(edge, edge) / pivot
        else:
            # this block has one eigenvalue of each sign
            rest = np.delete(np.arange(len(a)), [row, column])
            block, edge = a[np.ix_([row, column], [row, column])], a[np.ix_(rest, [row, column])]
            above += 1
            a = a[np.ix_(rest, rest)] - edge @ np.linalg.solve(block, edge.T)
        a = (a + a.T) / 2
    return above


@dataclass(frozen=True)
class Slice:
    low: float
    high: float
    count: int


def border(matrix: np.ndarray, wanted: int, low: float, high: float) -> tuple[float, int]:
    """A shift with ``wanted`` eigenvalues above it, near the middle of the gap below the last of them, and that
    number. Where eigenvalues coincide to rounding, the number is the next larger that a shift can have."""
    least = np.finfo(float).eps * 8 * abs(high)
    total = count_above(matrix, low)
    # the smallest interval in which the count passes from more than wanted to at most wanted, and from at least
    # wanted to fewer
    bottom, top, above = low, high, total
    while top - bottom > least:
        middle = (bottom + top) / 2
        count = count_above(matrix, middle)
        if count > wanted:
            bottom, above = middle, count
        else:
            top = middle
            if count < wanted:
                continue
    floor = top
    bottom2, top2 = floor, high
    if count_above(matrix, floor) < wanted:
        # the wanted number falls into a cluster: all of it is taken
        return bottom, above
    while top2 - bottom2 > least:
        middle = (bottom2 + top2) / 2
        if count_above(matrix, middle) >= wanted:
            bottom2 = middle
        else:
            top2 = middle
    return (floor + bottom2) / 2, wanted


def slices(matrix: np.ndarray, wanted: int, least: float, per_slice: int) -> list[Slice]:
    """Intervals from the top of the spectrum down that hold at least ``wanted`` eigenvalues above ``least``."""
    high = float(np.linalg.norm(matrix)) * 1.01
    out: list[Slice] = []
    done = 0
    while done < wanted:
        low, count = border(matrix, min(wanted, done + per_slice), least, high)
        out.append(Slice(low, out[-1].low if out else high, count - done))
        done = count
    return out


def in_slice(matrix: np.ndarray, part: Slice, nodes: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors inside a slice, as many as its inertia count says."""
    dims = len(matrix)
    places, weights = np.polynomial.legendre.leggauss(nodes)
    angles = np.pi / 2 * (1 - places)
    centre, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    norm = float(np.linalg.norm(matrix))
    block = min(dims, max(2 * part.count, part.count + 8))
    while True:
        vectors = np.random.default_rng(seed).standard_normal((dims, block))
        best = np.inf
        for _ in range(rounds):
            projected = np.zeros((dims, block))
            for angle, weight in zip(angles, weights):
                turn = radius * np.exp(1j * angle)
                solved = np.linalg.solve((centre + turn) * np.eye(dims) - matrix, vectors.astype(complex))
                projected += weight / 2 * (turn * solved).real
            basis, _ = np.linalg.qr(projected)
            small = basis.T @ matrix @ basis
            values, turned = np.linalg.eigh((small + small.T) / 2)
            vectors = basis @ turned
            inside = (values > part.low) & (values <= part.high)
            residual = np.abs(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside]).max(initial=0.0)
            if inside.sum() == part.count and residual <= 1e-15 * norm:
                break
            if inside.sum() == part.count and best <= 1e-12 * norm and residual > best / 2:
                break  # at rounding level
            best = min(best, residual) if inside.sum() == part.count else np.inf
        if inside.sum() == part.count and residual <= 1e-11 * norm:
            return values[inside], vectors[:, inside]
        if block == dims:
            raise ArithmeticError(f"{int(inside.sum())} eigenpairs found between {part.low} and {part.high}, {part.count} are there")
        block = min(dims, 2 * block)


def leading(matrix: np.ndarray, wanted: int, least: float = 0.0, per_slice: int = 4, nodes: int = 8, rounds: int = 30, seed: int = 7):
    """The ``wanted`` largest eigenvalues above ``least``, falling, and their unit eigenvectors as columns. Fewer, if
    the inertia count says that fewer are there."""
    wanted = min(wanted, count_above(matrix, least))
    if wanted == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    found = [in_slice(matrix, part, nodes, rounds, seed) for part in slices(matrix, wanted, least, per_slice)]
    # vectors of different slices are orthogonal up to their errors: one more Rayleigh-Ritz over all
    basis, _ = np.linalg.qr(np.hstack([vectors for _, vectors in found]))
    small = basis.T @ matrix @ basis
    values, turned = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:wanted]
    return values[order], basis @ turned[:, order]
