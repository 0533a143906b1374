"""Hashed subwords of whole texts, vectorised: byte n-grams inside words.

A word carries a blank at both ends as a boundary mark; an n-gram never reaches
beyond a boundary. ASCII letters are lower-cased.
"""

from __future__ import annotations

import numpy as np

SIZES = (3, 4)
_MIX = np.uint32(0x9E3779B1)


def buckets(texts: list[bytes | None], n_buckets: int):
    """Yields, for each n-gram size, (bucket numbers, their texts' bounds)."""
    parts = [b" " + b" ".join((t or b"").lower().split()) + b" " for t in texts]
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    for n in SIZES:
        if len(data) < n:
            yield np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
            continue
        size = len(data) - n + 1
        code = data[:size].astype(np.uint32) + np.uint32(n << 8)
        inside = np.ones(size, bool)
        for j in range(1, n):
            step = data[j:size + j]
            code = code * _MIX + step
            if j < n - 1:
                inside &= step != 32
        at = np.flatnonzero(inside)
        hashed = code[at] * _MIX
        yield ((hashed >> np.uint32(8)) % np.uint32(n_buckets)).astype(np.int64), \
            np.searchsorted(at, np.concatenate([[0], ends]))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds (0 where there are none)."""
    run = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return run[bounds[1:]] - run[bounds[:-1]]


def counts(text: bytes | None, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and how often each occurs."""
    found = np.concatenate([b for b, _ in buckets([text], n_buckets)])
    return np.unique(found, return_counts=True)
