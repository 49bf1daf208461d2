"""Suffix arrays in numpy: Larsson-Sadakane refinement and common prefixes."""

from __future__ import annotations

import numpy as np


def _packed(symbols: np.ndarray) -> tuple[np.ndarray, int, int]:
    """For every place, as many symbols from there on as one key holds, the first highest;
    their number and their bits.  Beyond the end come zeros, which no symbol gives."""
    n = len(symbols)
    bits = (int(symbols.max(initial=0)) + 1).bit_length()
    h = max(1, 62 // bits)
    above = symbols.astype(np.int64) + 1
    key = np.zeros(n, np.int64)
    for i in range(h):
        key <<= bits
        key[:max(0, n - i)] += above[i:]
    return key, h, bits


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``symbols`` and the rank (group number) of every suffix.

    Larsson-Sadakane: suffixes are grouped by their first ``h`` symbols (at first as many
    as one key holds), each
    group numbered by its first slot; every round sorts the members of the groups
    that are still tied by the group ``h`` symbols further on, and doubles ``h``.
    Sorted groups drop out."""
    n = len(symbols)
    key, h, _ = _packed(symbols)
    sa = np.argsort(key)
    key = key[sa]
    rank = np.empty(n, np.int64)
    if not n:
        return sa, rank

    def regroup(slots, members, new):
        first = np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))
        rank[members] = slots[first]
        tied = ~new
        tied[:-1] |= tied[1:]
        return slots[tied]

    slots = regroup(np.arange(n), sa, np.r_[True, key[1:] != key[:-1]])
    while len(slots):
        members = sa[slots]
        ahead = members + h
        key = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key += rank[members] * (n + 1)
        order = np.argsort(key)
        members, key = members[order], key[order]
        sa[slots] = members
        slots = regroup(slots, members, np.r_[True, key[1:] != key[:-1]])
        h *= 2
    return sa, rank


def common_prefixes(symbols: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each slot of ``sa``, the length of the prefix its suffix shares with the
    slot before (0 for the first), counted up to ``limit``.

    Kasai's argument (the prefix of a suffix is at least that of the suffix one
    position to the left, less one) bounds the work of a sequential scan; here all
    slots advance together, and by that argument a slot whose left neighbour
    in the text has reached ``l`` starts at ``l - 1``.  Symbols are compared as
    many at a time as one key holds."""
    n = len(symbols)
    if n < 2:
        return np.zeros(n, np.int64)
    words, h, bits = _packed(symbols)
    words = np.r_[words, 0]
    tails = np.int64(1) << (bits * np.arange(h, dtype=np.int64))  # k of them at or below a difference: h - k equal symbols
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    reach = np.zeros(n, np.int64)          # by text position
    stride = 16                            # every 16th position in full, then Kasai's start for the rest
    for offset in range(stride):
        live = np.arange(offset, n, stride)
        live = live[before[live] >= 0]
        at = np.maximum(reach[live - 1] - 1, 0) if offset else np.zeros(len(live), np.int64)
        while len(live):
            differ = words[live + at] ^ words[before[live] + at]
            at += h - np.searchsorted(tails, differ, side="right")
            reach[live] = at
            on = (differ == 0) & (at < limit)
            live, at = live[on], at[on]
    return np.minimum(reach, limit)[sa]
