"""Repeated strings of a byte buffer from its Burrows-Wheeler transform, in numpy.

``repeats`` derives the common prefixes of neighbouring suffixes by increasing value: the
interval of all suffixes is extended backwards by every byte that precedes it, breadth
first, and an interval found after k extensions whose upper border has no value yet gives
that border the value k - 1. The search stops at the least length asked for; borders that
then have no value lie between suffixes that share at least that many bytes.

All intervals of one value are extended together. A symbol's count up to a border comes from
counts at every BLOCK-th row and a lookup in the sorted rows of the symbol.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: So many symbols of nine bits make the first key.
FIRST = 7


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by doubling; only undecided groups are sorted again."""
    n = len(text)
    padded = np.concatenate((text.astype(np.uint64), np.zeros(FIRST, np.uint64)))
    key = padded[:n].copy()
    for k in range(1, FIRST):
        key = (key << np.uint64(9)) | padded[k : n + k]
    order = np.argsort(key)
    fresh = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    group = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]  # a group is named by its first row
    rank = np.empty(n, np.int64)
    rank[order] = group
    width = FIRST
    while width < depth:
        size = np.diff(np.append(np.flatnonzero(fresh), n))
        open_rows = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_rows):
            break
        of = order[open_rows]
        later = np.where(of + width < n, rank[np.minimum(of + width, n - 1)] + 1, 0)
        place = np.argsort(rank[of] * (n + 1) + later)
        of, later = of[place], later[place]
        order[open_rows] = of
        old = rank[of]
        change = np.concatenate(([True], (old[1:] != old[:-1]) | (later[1:] != later[:-1])))
        fresh[open_rows] = change
        rank[of] = open_rows[np.flatnonzero(change)[np.cumsum(change) - 1]]
        width *= 2
    return order


def _first_and_last(low: np.ndarray, high: np.ndarray, bwt: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last row of each symbol in each interval. Intervals of one row, most of them late on, need no sort."""
    size = high - low
    one, wide = low[size == 1], size > 1
    low, size = low[wide], size[wide]
    if not len(low):
        return one, one
    total = int(size.sum())
    owner = np.repeat(np.arange(len(low)), size)
    rows = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
    keys = owner * symbols + bwt[rows]
    if len(low) * symbols <= 4 * total:  # few wide intervals: a slot for each pair; of several writes the last stays
        first, last = np.full(len(low) * symbols, -1), np.full(len(low) * symbols, -1)
        first[keys[::-1]] = rows[::-1]
        last[keys] = rows
        first, last = first[first >= 0], last[last >= 0]
    else:
        order = np.argsort(keys, kind="stable")  # owners ascend, which this sort takes as it comes
        told = keys[order]
        at = np.flatnonzero(np.concatenate(([True], told[1:] != told[:-1])))
        first, last = rows[order[at]], rows[order[np.append(at[1:], total) - 1]]
    return np.concatenate((one, first)), np.concatenate((one, last))


def long_borders(bwt: np.ndarray, symbols: int, least: int) -> np.ndarray:
    """For each row whether its suffix shares at least ``least`` symbols with that of the row before.

    Symbol 0 ends a text and is extended only at the outset, so that no string goes over an end.
    """
    n = len(bwt)
    # The k-th row with a symbol leads to the k-th suffix that begins with it.
    leads = np.empty(n, np.int64)
    leads[np.argsort(bwt, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.array([0]), np.array([n])
    for value in range(least):
        first, last = _first_and_last(low, high, bwt, symbols)
        low, high = leads[first], leads[last] + 1
        fresh = ~known[high] & ((bwt[first] > 0) | (value == 0))
        if value == 0:
            fresh |= high == n  # the last symbol's interval has the end of all rows for a border
        low, high = low[fresh], high[fresh]
        known[high] = True
        if not len(low):
            break
    return ~known[:n]


def repeats(texts: list[bytes], least: int) -> list[np.ndarray]:
    """For each text, at which places a string of ``least`` bytes starts that also starts at another place of any text."""
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + 1
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    data[ends] = 0
    order = suffix_array(data, least + 1)
    borders = np.append(long_borders(data[order - 1], 257, least), False)
    twice = np.zeros(len(data), bool)
    twice[order] = borders[:-1] | borders[1:]
    starts = ends - sizes
    return [np.flatnonzero(twice[a : max(a, b - least + 1)]) for a, b in zip(starts, ends)]
