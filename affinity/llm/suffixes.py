"""Suffix sorting in numpy, for arrays that fit in one task."""

from __future__ import annotations

import numpy as np

from affinity.llm.frames import travels

travels(__name__)


def packed(text: np.ndarray, bits: int, most: int | None = None) -> tuple[np.ndarray, int]:
    """For each place the next few symbols as one number, and how many; zeros follow the end."""
    p = max(1, 63 // bits)
    p = min(p, most) if most else p
    n = len(text)
    wide = np.zeros(n + p, np.uint64)
    wide[:n] = text
    key = np.zeros(n, np.uint64)
    for j in range(p):
        key = (key << np.uint64(bits)) | wide[j : j + n]
    return key, p


def suffix_array(text: np.ndarray, bits: int, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of all suffixes by Larsson and Sadakane's refinement.

    Suffixes are sorted by their first symbols, packed into a number; then the
    sorted length doubles in each round by the ranks found so far, and only
    groups that are still tied are sorted again. With ``depth``, suffixes are
    compared by exactly that many symbols, and equal ones share a rank: the
    place of their group's first member. Symbols need ``bits`` bits; a text
    that ends in a smallest symbol of its own gives a total order.
    """
    n = len(text)
    key, h = packed(text, bits, depth)
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
    del key
    starts = np.flatnonzero(fresh)
    size = np.diff(np.r_[starts, n])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, size)
    tied = np.flatnonzero(np.repeat(size > 1, size))
    while len(tied) and (depth is None or h < depth):
        step = h if depth is None else min(h, depth - h)
        sub = order[tied]
        group = rank[sub]
        after = sub + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        _, dense = np.unique(group, return_inverse=True)
        mixed = dense.astype(np.int64) * (n + 1) + second
        by = np.argsort(mixed, kind="stable")
        sub, mixed = sub[by], mixed[by]
        order[tied] = sub
        fresh = np.r_[True, mixed[1:] != mixed[:-1]]
        at = np.flatnonzero(fresh)
        size = np.diff(np.r_[at, len(sub)])
        # A group of ties fills consecutive places of the order.
        rank[sub] = np.repeat(tied[at], size)
        tied = tied[np.repeat(size > 1, size)]
        h += step
    return order, rank
