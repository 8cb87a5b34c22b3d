"""Suffix order by the difference-cover algorithm, in numpy."""

from __future__ import annotations

import numpy as np


def packed(*columns: np.ndarray) -> np.ndarray:
    """Integers in the same order as the rows of non-negative ``columns``."""
    out = columns[0].astype(np.int64)
    for column in columns[1:]:
        top, width = int(out.max(initial=0)) + 1, int(column.max(initial=0)) + 1
        if top * width >= 1 << 62:
            out = np.unique(out, return_inverse=True)[1].astype(np.int64)
        out = out * width + column
    return out


def named(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1; equal keys share one."""
    order = np.argsort(keys)
    ordered = keys[order]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else ordered
    return names


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (symbols from 1) in their order.

    Suffixes at positions of remainder 1 or 2 modulo 3 are sorted by triples of symbols; where triples repeat, the names
    of the triples are a text of two thirds the length, whose suffixes are sorted in the same way. The remaining suffixes are
    sorted by their first symbol and the rank of the next one, and merged in.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(4, np.int64)])
    # A sampled position n - 1 + (1 when n leaves 1) keeps the two halves of the reduced text apart by zeros.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sampled = np.concatenate([one, two])
    names = named(packed(padded[sampled], padded[sampled + 1], padded[sampled + 2]))
    if names.max() < len(names):
        in_order = sampled[suffix_order(names)]
    else:
        in_order = np.empty_like(sampled)
        in_order[names - 1] = sampled
    rank = np.zeros(n + 4, np.int64)
    rank[in_order] = np.arange(1, len(in_order) + 1)
    rank[n:] = 0
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(packed(padded[rest], rank[rest + 1]))]
    own = in_order[in_order < n]
    by_one, by_two = own[own % 3 == 1], own[own % 3 == 2]
    # Against remainder 1, one symbol reaches sampled positions on both sides; against remainder 2, two symbols do.
    first = packed(padded[np.concatenate([rest, by_one])], rank[np.concatenate([rest, by_one]) + 1])
    second = packed(*(padded[np.concatenate([rest, by_two]) + i] for i in (0, 1)), rank[np.concatenate([rest, by_two]) + 2])
    k = len(rest)
    place = np.empty(n, np.int64)
    place[rest] = np.arange(k) + np.searchsorted(first[k:], first[:k], side="left") + np.searchsorted(second[k:], second[:k], side="left")
    taken = np.zeros(n, bool)
    taken[place[rest]] = True
    order = np.empty(n, np.int64)
    order[place[rest]] = rest
    order[~taken] = own
    return order
