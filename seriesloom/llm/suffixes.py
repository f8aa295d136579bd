"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

Positions are classified as smaller (S) or larger (L) than the one behind them. The leftmost S positions
of each run are sorted by their substrings, named, and sorted as suffixes by recursion on the names;
their order induces that of all L suffixes in one scan from the left, and these that of all S suffixes
in one scan from the right. A scan takes as many slots at a time as are filled already: what it induces
always lands behind them, so whole stretches go through numpy and the work stays linear. The recursion
ends where few names are left.
"""

from __future__ import annotations

import numpy as np

from seriesloom.llm.common import ship

ship(__name__)

#: A string of names of at most this length ends the recursion.
SHORT = 1 << 17


def _smaller_types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one counts as S."""
    n = len(s)
    differs = np.flatnonzero(s[1:] != s[:-1])
    # Of a run of equal symbols all have the type of its last one.
    out = np.ones(n, dtype=bool)
    out[:-1] = (s[differs + 1] > s[differs]).repeat(np.diff(differs, prepend=-1))
    return out


def _grouped(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol; in that order the symbols and their places in their groups; the groups' symbols and sizes."""
    both = symbols.astype(np.int64) << 32
    both |= np.arange(len(symbols))
    both.sort()
    order, ordered = both & 0xFFFFFFFF, both >> 32
    begins = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
    first = begins.nonzero()[0]
    counts = np.empty_like(first)
    np.subtract(first[1:], first[:-1], out=counts[:-1])
    if len(first):
        counts[-1] = len(ordered) - first[-1]
    return order, ordered, np.arange(len(ordered)) - first.repeat(counts), ordered[first], counts


def _induce(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, kinds: int) -> np.ndarray:
    """All suffixes in order, from the leftmost S positions ``seeds`` in (assumed) order."""
    n = len(s)
    sizes = np.bincount(s, minlength=kinds)
    larger_sizes = np.bincount(s[~smaller], minlength=kinds)
    seed_sizes = np.bincount(s[seeds], minlength=kinds)
    # Symbol and type of the position before each one; the first has none of either type.
    earlier = np.empty_like(s)
    earlier[1:], earlier[0] = s[:-1], 0
    earlier_larger, earlier_smaller = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    earlier_larger[1:], earlier_smaller[1:] = ~smaller[:-1], smaller[:-1]

    # Left to right over the L suffixes of each symbol followed by its seeds.
    slots = larger_sizes + seed_sizes
    free = np.cumsum(slots) - slots
    scan = np.full(int(slots.sum()), -1, dtype=np.int64)
    order, symbols, place, _, _ = _grouped(s[seeds])
    scan[(free + larger_sizes)[symbols] + place] = seeds[order]
    at, reach = 0, 64
    while at < len(scan):
        items = scan[at : at + reach]
        empty = items < 0
        filled = int(empty.argmax()) or (0 if empty[0] else len(empty))
        items = items[:filled]
        at += filled
        reach = max(64, 2 * filled)
        items = items[earlier_larger[items]]
        if len(items):
            order, symbols, place, found, counts = _grouped(earlier[items])
            scan[free[symbols] + place] = items[order] - 1
            free[found] += counts

    # Right to left: the L suffixes stand, the S suffixes of each symbol fill up from its end.
    out = np.full(n, -1, dtype=np.int64)
    ordered = scan[~smaller[scan]]
    starts = np.cumsum(sizes) - sizes
    shift = starts - (np.cumsum(larger_sizes) - larger_sizes)
    out[np.arange(len(ordered)) + shift.repeat(larger_sizes)] = ordered
    out[0] = n - 1
    free = starts + sizes - 1
    end, reach = n, 64
    while end > 1:
        items = out[max(0, end - reach) : end][::-1]
        empty = items < 0
        filled = int(empty.argmax()) or (0 if empty[0] else len(empty))
        items = items[:filled]
        end -= filled
        reach = max(64, 2 * filled)
        items = items[earlier_smaller[items]]
        if len(items):
            order, symbols, place, found, counts = _grouped(earlier[items])
            out[free[symbols] - place] = items[order] - 1
            free[found] -= counts
    return out


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """All suffixes of a short string of names in order: ranks of ever longer heads, sorted in pairs."""
    n, step = len(names), 1
    rank = names.astype(np.int64)
    while True:
        behind = np.zeros(n, dtype=np.int64)
        behind[:-step] = rank[step:] + 1
        both = rank * (n + 1) + behind
        order = both.argsort(kind="stable")
        ordered = both[order]
        rank[order[0]] = 0
        rank[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


def suffix_array(s: np.ndarray, kinds: int) -> np.ndarray:
    """Starts of all suffixes of ``s`` in order; its symbols are below ``kinds``, its last is 0 and no other is."""
    n = len(s)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = _smaller_types(s)
    leftmost = np.zeros(n, dtype=bool)
    leftmost[1:] = smaller[1:] & ~smaller[:-1]
    seeds = np.flatnonzero(leftmost)
    ordered = _induce(s, smaller, seeds, kinds)
    ordered = ordered[leftmost[ordered]]
    # Equal substrings from one seed to the next get one name.
    lengths = np.zeros(n, dtype=np.int64)
    lengths[seeds] = np.diff(seeds, append=n)
    left, right = ordered[:-1], ordered[1:]
    same = lengths[left] == lengths[right]
    open_pairs = np.flatnonzero(same)
    step = 0
    while len(open_pairs):
        a, b = left[open_pairs] + step, right[open_pairs] + step
        equal = s[np.minimum(a, n - 1)] == s[np.minimum(b, n - 1)]
        same[open_pairs[~equal]] = False
        open_pairs = open_pairs[equal & (lengths[left[open_pairs]] > step)]
        step += 1
    names = np.zeros(n, dtype=np.int32)
    names[ordered[1:]] = np.cumsum(~same)
    count = int(names[ordered[-1]]) + 1
    if count < len(seeds):
        short = names[seeds]
        ordered = seeds[_by_doubling(short) if len(short) <= SHORT else suffix_array(short, count)]
    return _induce(s, smaller, ordered, kinds)


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of each position, the symbols its suffix shares with the one before it in ``order``.

    A position whose predecessor follows its own predecessor's shares one symbol less than that; only
    the others are compared, four symbols at a time.
    """
    n = len(s)
    earlier = np.full(n, -1, dtype=np.int64)
    earlier[order[1:]] = order[:-1]
    at = np.arange(n)
    fresh = (earlier <= 0) | (at == 0)
    fresh[1:] |= s[:-1] != s[np.maximum(earlier[1:], 1) - 1]
    starts = np.flatnonzero(fresh & (earlier >= 0))
    padded = np.r_[s.astype(np.uint64) + np.uint64(1), np.zeros(8, dtype=np.uint64)]
    words = padded[:-3] | (padded[1:-2] << np.uint64(16)) | (padded[2:-1] << np.uint64(32)) | (padded[3:] << np.uint64(48))
    shared = np.zeros(n, dtype=np.int64)
    for table, step in ((words, 4), (padded, 1)):
        live = starts
        while len(live):
            a, b = live + shared[live], earlier[live] + shared[live]
            inside = (a < n) & (b < n)
            equal = inside & (table[np.minimum(a, n)] == table[np.minimum(b, n)])
            live = live[equal]
            shared[live] += step
    last = np.maximum.accumulate(np.where(fresh, at, 0))
    out = shared[last] - (at - last)
    out[earlier < 0] = 0
    return out
