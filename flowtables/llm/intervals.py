"""Which substrings of a given length recur among some texts: intervals of a Burrows-Wheeler transform, by breadth.

Suffixes are ordered by prefix doubling, no further than the length asked for. On the transform of that order, backward
extension goes breadth first (Beller, Gog, Ohlebusch and Schnattinger 2013): step l takes the intervals of strings of l
symbols, extends each by every symbol before it, and where such an interval ends at a place that has no value yet, the
common prefix there has l symbols. Values thus come in increasing order, and the search ends at the length asked for;
places without a value then have a common prefix of at least that length.
"""

from __future__ import annotations

import numpy as np

_FIRST_DEPTH = 7


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` symbols (below 512) at least."""
    n = len(symbols)
    padded = np.concatenate((symbols, np.zeros(_FIRST_DEPTH, symbols.dtype))).astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for j in range(_FIRST_DEPTH):
        keys = (keys << np.uint64(9)) | padded[j : j + n]
    order = np.argsort(keys)
    keys = keys[order]
    opens = np.ones(n + 1, bool)
    opens[1:n] = keys[1:] != keys[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens[:n], np.arange(n), 0))
    known = _FIRST_DEPTH
    while known < depth:
        tied = np.flatnonzero(~(opens[:-1] & opens[1:]))
        if not len(tied):
            break
        own = order[tied]
        later = own + known
        second = np.where(later < n, rank[np.minimum(later, n - 1)] + 1, 0)
        both = (rank[own] << 32) | second
        moved = np.argsort(both)
        own, both = own[moved], both[moved]
        order[tied] = own
        new = np.ones(len(tied), bool)
        new[1:] = both[1:] != both[:-1]
        opens[tied] |= new
        rank[own] = np.maximum.accumulate(np.where(new, tied, 0))
        known *= 2
    return order


def common_prefix_borders(last: np.ndarray, length: int) -> np.ndarray:
    """Places of the order whose suffix has fewer than ``length`` symbols in common with the one before.

    ``last`` is the transform, with 0 for the end of a text; the last place, beyond all suffixes, is a border too.
    """
    n = len(last)
    by_symbol = np.argsort(last, kind="stable")
    target = np.empty(n, np.int64)
    target[by_symbol] = np.arange(n)
    same = last[by_symbol[1:]] == last[by_symbol[:-1]]
    after, before = np.full(n, n), np.full(n, -1)
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    low, high = np.zeros(1, np.int64), np.full(1, n - 1)
    for step in range(length):
        if not len(low):
            break
        sizes = high - low + 1
        one = low[sizes == 1]
        low, high, sizes = low[sizes > 1], high[sizes > 1], sizes[sizes > 1]
        # First and last place of each symbol in each interval.
        at = np.arange(int(sizes.sum())) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        ends, begins = np.flatnonzero(after[at] > high[owner]), np.flatnonzero(before[at] < low[owner])
        ends = at[ends[np.argsort(owner[ends] * 512 + last[at[ends]])]]
        begins = at[begins[np.argsort(owner[begins] * 512 + last[at[begins]])]]
        low, high = np.concatenate((begins, one)), np.concatenate((ends, one))
        if step:
            # Nothing goes on before the beginning of a text.
            inner = last[low] > 0
            low, high = low[inner], high[inner]
        low, high = target[low], target[high]
        new = ~border[high + 1]
        low, high = low[new], high[new]
        border[high + 1] = True
    return border


def repeated_starts(data: np.ndarray, borders: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """Where a substring of ``length`` bytes starts that starts elsewhere too; text i counts ``weights[i]`` times."""
    out = np.zeros(len(data), bool)
    sizes = np.diff(borders)
    n = len(data) + len(sizes)
    if n == 0 or sizes.max(initial=0) < length:
        return out
    symbols = np.zeros(n, np.uint16)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(data)) + text
    symbols[place] = data.astype(np.uint16) + 1
    order = suffix_order(symbols, length)
    border = common_prefix_borders(symbols[order - 1], length)
    weight = np.zeros(n, np.int64)
    weight[place] = np.where(borders[text + 1] - np.arange(len(data)) >= length, weights[text], 0)
    group = np.cumsum(border[:-1]) - 1
    total = np.bincount(group, weights=weight[order])
    repeated = np.empty(n, bool)
    repeated[order] = total[group] > 1
    return repeated[place] & (weight[place] > 0)
