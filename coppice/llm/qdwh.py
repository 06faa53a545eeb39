"""Eigenvectors of a symmetric matrix by spectral divide and conquer on QDWH polar decompositions.

The unitary polar factor of ``A - s I`` has the eigenvectors of ``A``, with 1 where an eigenvalue lies
above ``s`` and -1 below. Half of its sum with the identity projects onto the upper eigenvectors; an
orthonormal basis of that space and its complement cut ``A`` into two blocks, which are divided
in the same way. Only blocks that hold one of the wanted eigenvalues are followed. Matrices here
have the size of an embedding, so all of this is small work of the driver.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
# The dynamically weighted iteration converges cubically: six steps do at a condition of 1e16.
_MOST_STEPS = 15
# From this weight on a step is taken with a QR factorisation, below with a Cholesky factorisation.
_QR_WEIGHT = 100.0


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Unitary factor of the polar decomposition of a square matrix, by dynamically weighted Halley steps."""
    n = len(a)
    eye = np.eye(n)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    try:
        low = 1.0 / np.linalg.norm(np.linalg.solve(np.linalg.qr(x, mode="r"), eye))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(1.0, max(low, EPS))
    for _ in range(_MOST_STEPS):
        sq = low * low
        d = (4 * (1 - sq) / (sq * sq)) ** (1 / 3)
        root = np.sqrt(1 + d)
        w = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - sq) / (sq * root))
        b = (w - 1) ** 2 / 4
        c = w + b - 1
        if c > _QR_WEIGHT:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            new = b / c * x + (w - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        else:
            lower = np.linalg.cholesky(eye + c * x.T @ x)
            new = b / c * x + (w - b / c) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        low = min(1.0, low * (w + b * sq) / (1 + c * sq))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low < 10 * EPS and moved < (5 * EPS) ** (1 / 3):
            break
    return x


def _divide(a: np.ndarray):
    """Bases of the upper and the lower part of the spectrum of ``a``, or None where the eigenvalues
    are equal to working precision. The cut is tried at their mean first, then beside it, as a cut on
    an eigenvalue leaves that one on neither side."""
    m = len(a)
    mean = np.trace(a) / m
    deviation = np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m)
    noise = 4 * m * EPS * np.linalg.norm(a)
    if deviation <= noise:
        return None
    start = np.random.default_rng(m).standard_normal((m, m))
    best = None
    for step in (0, 0.21, -0.21, 0.43, -0.43, 0.67, -0.67, 0.9, -0.9):
        upper = (polar_factor(a - (mean + step * deviation) * np.eye(m)) + np.eye(m)) / 2
        k = round(float(np.trace(upper)))
        if not 0 < k < m:
            continue
        basis, _ = np.linalg.qr(upper @ start[:, :k])
        basis, _ = np.linalg.qr(upper @ basis)
        full, _ = np.linalg.qr(basis, mode="complete")
        basis, rest = full[:, :k], full[:, k:]
        coupled = np.linalg.norm(rest.T @ a @ basis)
        if best is None or coupled < best[0]:
            best = coupled, basis, rest
        if coupled <= noise:
            break
    return best and best[1:]


def _sym(a: np.ndarray) -> np.ndarray:
    return (a + a.T) / 2


def leading_eigenvectors(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of the symmetric ``a``, falling, and their unit vectors as columns."""
    n = len(a)
    found: list[np.ndarray] = []
    todo = [(_sym(a), np.eye(n))]
    while todo and sum(v.shape[1] for v in found) < wanted:
        block, basis = todo.pop()
        parts = _divide(block) if len(block) > 1 else None
        if parts is None:
            found.append(basis)
            continue
        upper, lower = parts
        # The upper part is on top of the stack: the lower one is followed only if it is needed.
        todo.append((_sym(lower.T @ block @ lower), basis @ lower))
        todo.append((_sym(upper.T @ block @ upper), basis @ upper))
    vectors = np.hstack(found)
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]
