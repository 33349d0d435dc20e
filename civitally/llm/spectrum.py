"""Leading eigenpairs of a symmetric matrix by spectrum slicing, in numpy."""

from __future__ import annotations

import numpy as np

_GROWTH = (1 + 17 ** 0.5) / 8
_EPS = np.finfo(float).eps


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix exceed the shift.

    L D Lᵀ of matrix - shift I with symmetric pivoting in blocks of one and two; by Sylvester's law
    D has as many positive eigenvalues as the shifted matrix. A block of two has one of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        column = np.abs(a[1:, 0])
        r = 1 + int(np.argmax(column)) if len(column) else 0
        off = column[r - 1] if r else 0.0
        if off == 0.0:
            above += bool(a[0, 0] > 0)
            a = a[1:, 1:]
            continue
        if abs(a[0, 0]) < _GROWTH * off:
            across = np.abs(a[r]).copy()
            across[r] = 0.0
            most = across.max()
            if abs(a[0, 0]) * most < _GROWTH * off * off:
                if abs(a[r, r]) >= _GROWTH * most:
                    order = [r, *(i for i in range(len(a)) if i != r)]
                    a = a[np.ix_(order, order)]
                else:
                    order = [0, r, *(i for i in range(1, len(a)) if i != r)]
                    a = a[np.ix_(order, order)]
                    block, rest = a[:2, :2], a[2:, :2]
                    a = a[2:, 2:] - rest @ np.linalg.solve(block, rest.T)
                    a = (a + a.T) / 2
                    above += 1
                    continue
        above += bool(a[0, 0] > 0)
        a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
    return above


def _polish(matrix: np.ndarray, start: np.ndarray, shift: float, found: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from one solve at ``shift``, kept orthogonal to the vectors found before."""
    def clear(v):
        for _ in range(2):
            v = v - found.T @ (found @ v)
        return v / np.linalg.norm(v)

    identity, vector, value = np.eye(len(matrix)), clear(start), shift
    for step in range(12):
        try:
            solved = np.linalg.solve(matrix - value * identity, vector)
        except np.linalg.LinAlgError:
            # The shift is an eigenvalue to the last bit: move it by less than the result's own error.
            solved = np.linalg.solve(matrix - (value + scale * _EPS) * identity, vector)
        if not np.all(np.isfinite(solved)) or not np.linalg.norm(solved):
            break
        vector = clear(solved / np.abs(solved).max())
        value = float(vector @ (matrix @ vector))
        if step >= 1 and np.linalg.norm(matrix @ vector - value * vector) <= 4 * _EPS * scale * len(matrix) ** 0.5:
            break
    return value, vector


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors as rows.

    Counts of eigenvalues above a shift (``count_above``) halve an interval until it holds one eigenvalue
    alone or is as narrow as rounding allows (equal eigenvalues). Rayleigh quotient iteration then settles
    the pair; where it runs to another eigenvalue, the interval is halved further and it starts anew. At the end
    counts just above and below each value certify its number. Signs: the largest entry is positive.
    """
    size = len(matrix)
    k = min(k, size)
    if not k:
        return np.zeros(0), np.zeros((0, size))
    scale = float(np.abs(matrix).sum(axis=1).max())
    if scale == 0.0:
        return np.zeros(k), np.eye(k, size)
    tiny = 8 * _EPS * scale * size ** 0.5
    counts = {scale * 1.01: 0, -scale * 1.01: size}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(matrix, shift)
        return counts[shift]

    def numbered(value: float, number: int) -> bool:
        slack = 4 * tiny + 1e-13 * abs(value)
        return above(value - slack) >= number > above(value + slack)

    values, vectors = np.zeros(k), np.zeros((k, size))
    noise = np.random.default_rng(11).standard_normal((k, size))
    for number in range(1, k + 1):
        low = max(s for s, n in counts.items() if n >= number)
        high = min(s for s, n in counts.items() if n < number)
        while True:
            alone = above(low) - above(high) == 1
            if not alone and high - low > tiny:
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= number else (low, middle)
                continue
            value, vector = _polish(matrix, noise[number - 1], (low + high) / 2, vectors[:number - 1], scale)
            if numbered(value, number) or high - low <= tiny:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        values[number - 1], vectors[number - 1] = value, vector
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[order]
    for number, value in enumerate(values, 1):
        if not numbered(value, number):
            raise ArithmeticError(f"eigenvalue {number} is not where the counts place it")
    vectors *= np.sign(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)])[:, None]
    return values, vectors
