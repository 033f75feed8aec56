"""Repeated windows of byte strings by a Burrows-Wheeler transform.

The common prefixes of neighbouring suffixes are derived by increasing value: intervals
of suffixes with a common prefix are extended to the left by one byte at a time, breadth
first, and the expansion stops at the least length that counts.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = b"\xff"  # in no UTF-8 text


def suffix_array(text: np.ndarray, least: int) -> np.ndarray:
    """Suffixes in the order of their first ``least`` bytes at least, by prefix doubling."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.diff(text[order].astype(np.int64), prepend=-1) != 0)
    k = 1
    while k < n:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:]
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order], prepend=-1) != 0
        rank[order] = np.cumsum(steps)
        k *= 2
        if k >= 2 * least or rank[order[-1]] == n:
            break
    return order


def long_prefixes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix shares its first ``least`` bytes with the one before it in the order."""
    n = len(text)
    before = text[order - 1].astype(np.int64)  # the transform; the text is taken as a ring
    by_byte = np.argsort(before, kind="stable")
    step = np.empty(n, np.int64)
    step[by_byte] = np.arange(n)  # where the suffix that begins one byte earlier stands
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(least):
        if not len(low):
            break
        sizes = high - low + 1
        owner = np.repeat(np.arange(len(low)), sizes)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
        key = owner * 256 + before[inside]
        place = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[place], prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        new_low, new_high = step[inside[place[first]]], step[inside[place[last]]]
        fresh = ~known[new_high + 1]
        known[new_high[fresh] + 1] = True
        low, high = new_low[fresh], new_high[fresh]
    return ~known[:n]


def repeated_starts(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string the places where ``least`` bytes start that also start elsewhere in the strings."""
    joined = np.frombuffer(SEPARATOR.join(strings) + SEPARATOR, np.uint8)
    order = suffix_array(joined, least)
    same = long_prefixes(joined, order, least)
    flags = np.zeros(len(joined), bool)
    flags[order[same]] = True
    flags[order[np.flatnonzero(same) - 1]] = True
    found, at = [], 0
    for s in strings:
        found.append(np.flatnonzero(flags[at : at + max(0, len(s) - least + 1)]))
        at += len(s) + 1
    return found
