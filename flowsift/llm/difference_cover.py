"""Suffix arrays of integer arrays by the difference cover {1, 2} modulo 3, in numpy."""

from __future__ import annotations

import numpy as np


def _packed(keys: list[np.ndarray], limit: int) -> np.ndarray | None:
    """Several keys below limit as one number that sorts as they do, the first weighing most."""
    bits = len(keys) * int(limit).bit_length()
    if bits > 63:
        return None
    packed = keys[0].astype(np.int32 if bits < 32 else np.int64)
    for k in keys[1:]:
        packed = packed * packed.dtype.type(limit) + k.astype(packed.dtype)
    return packed


def _sorted_by(keys: list[np.ndarray], limit: int) -> np.ndarray:
    """Order by several keys below limit. Equal keys stand in any order."""
    packed = _packed(keys, limit)
    return np.lexsort(keys[::-1]) if packed is None else np.argsort(packed)


def _before(theirs: list[np.ndarray], mine: list[np.ndarray], limit: int) -> np.ndarray:
    """How many of theirs, which are in order, are smaller than each of mine, which are in order."""
    packed = _packed(theirs, limit)
    if packed is not None:
        return np.searchsorted(packed, _packed(mine, limit))
    merged = np.lexsort([np.concatenate([a, b]) for a, b in zip(mine, theirs)][::-1])
    from_theirs = merged >= len(mine[0])
    smaller = np.empty(len(mine[0]), np.int64)
    smaller[merged[~from_theirs]] = np.cumsum(from_theirs)[~from_theirs]
    return smaller


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Values are from 1 on; the end sorts before every value."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    limit = int(text.max()) + 2
    kind = np.int32 if max(n + 3, limit) < 2 ** 31 else np.int64
    padded = np.concatenate([text.astype(kind), np.zeros(3, kind)])

    # Sampled suffixes: sort their triples and name them; equal names are sorted by recursion.
    ones = np.arange(1, n + (n % 3 == 1), 3)  # one beyond the end, so that every 0 has a 1 after it
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triples = [padded[sample + k] for k in range(3)]
    order = _sorted_by(triples, limit)
    new = np.zeros(len(order), bool)
    new[0] = True
    for t in triples:
        new[1:] |= t[order[1:]] != t[order[:-1]]
    names = np.empty(len(order), kind)
    names[order] = np.cumsum(new, dtype=kind)
    del triples
    if int(names.max()) < len(names):
        order = suffix_array(names)
    rank = np.zeros(n + 3, kind)
    rank[sample[order]] = np.arange(1, len(order) + 1, dtype=kind)
    sampled = sample[order]
    sampled = sampled[sampled < n]

    # The other suffixes: their first value, then the rank of the sampled suffix after it.
    zeros = np.arange(0, n, 3)
    others = zeros[_sorted_by([padded[zeros], rank[zeros + 1]], max(limit, len(order) + 2))]

    # Merge: a sampled suffix is compared by one value and a rank, or by two values and a rank.
    # Both the others and the samples of a kind are in order, so places are looked up.
    place = np.zeros(len(others), np.int64)
    for kind in (1, 2):
        own = sampled[sampled % 3 == kind]
        if kind == 1:
            theirs = [padded[own], rank[own + 1]]
            mine = [padded[others], rank[others + 1]]
        else:
            theirs = [padded[own], padded[own + 1], rank[own + 2]]
            mine = [padded[others], padded[others + 1], rank[others + 2]]
        place += _before(theirs, mine, max(limit, len(order) + 2))
    out = np.empty(n, np.int64)
    at = place + np.arange(len(others))
    taken = np.zeros(n, bool)
    taken[at] = True
    out[at] = others
    out[~taken] = sampled
    return out


def equal_prefixes(data: np.ndarray, starts: np.ndarray, length: int, at_once: int = 200_000) -> np.ndarray:
    """For sorted starts: whether each has the same next `length` bytes as the one before it. Bytes
    are compared eight at a time, those that differ in the first eight no further."""
    same = np.zeros(len(starts), bool)
    if length < 8:
        step = np.arange(length)
        same[1:] = (data[starts[1:, None] + step] == data[starts[:-1, None] + step]).all(axis=1)
        return same
    raw = np.ascontiguousarray(data, np.uint8)
    eight = np.zeros(max(len(raw) - 7, 0), np.uint64)
    for k in range(8):
        own = raw[k:k + (len(raw) - k) // 8 * 8].view("<u8")
        eight[k::8] = own[:len(eight[k::8])]
    for i in range(1, len(starts), at_once):
        here = np.arange(i, min(i + at_once, len(starts)))
        for at in [*range(0, length - 8, 8), length - 8]:
            here = here[eight[starts[here] + at] == eight[starts[here - 1] + at]]
        same[here] = True
    return same
