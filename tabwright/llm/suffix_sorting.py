"""Linear suffix sorting by grouping, without recursion or renaming.

First phase: suffixes start in groups of equal first symbols. Groups are taken in
descending order. Each suffix of the group finds, by following the pointers of higher
suffixes, the nearest suffix before it that is in a lower group; those so found move out
of their groups into new ones directly above, the more often found the higher. In the
end the groups order suffixes by their Lyndon prefixes. Second phase: going up the ranks,
the suffix before each ranked one, and then those along its pointers, take the next free
rank of their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """Start of each suffix in order; ``text`` must end with its only least symbol."""
    n = len(text)
    if n == 0:
        return []
    order = np.argsort(text, kind="stable")
    in_order = text[order]
    new = np.concatenate(([True], in_order[1:] != in_order[:-1]))
    starts = np.flatnonzero(new)
    sizes = np.zeros(n, np.int64)
    sizes[starts] = np.diff(np.concatenate((starts, [n])))
    of = np.empty(n, np.int64)
    of[order] = starts[np.cumsum(new) - 1]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    sa, group, at, size = order.tolist(), of.tolist(), place.tolist(), sizes.tolist()
    before = [-1] * n
    high = n - 1
    while high >= 0:
        low = group[sa[high]]
        if low == high:
            # A group of one, which most are.
            p = sa[high] - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[sa[high]] = p
            if p >= 0:
                g = group[p]
                last = g + size[g] - 1
                if last > g:
                    i, other = at[p], sa[last]
                    sa[i], at[other] = other, i
                    sa[last], at[p] = p, last
                    size[g] = last - g
                    size[last] = 1
                    group[p] = last
            high = low - 1
            continue
        found: dict[int, int] = {}
        for s in sorted(sa[low : high + 1]):
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[s] = p
            if p >= 0:
                found[p] = found.get(p, 0) + 1
        high = low - 1
        if not found:
            continue
        by_times: dict[int, list[int]] = {}
        for p, times in found.items():
            by_times.setdefault(times, []).append(p)
        for times in sorted(by_times, reverse=True):
            moved = by_times[times]
            touched: dict[int, int] = {}
            for p in moved:
                g = group[p]
                last = g + size[g] - 1
                i, other = at[p], sa[last]
                sa[i], at[other] = other, i
                sa[last], at[p] = p, last
                size[g] -= 1
                touched[g] = touched.get(g, 0) + 1
            # Moved suffixes of one old group lie together behind what is left of it.
            for p in moved:
                g = group[p]
                if size[g]:
                    first = g + size[g]
                    group[p] = first
                    size[first] += 1
            for g, times_moved in touched.items():
                if not size[g]:
                    size[g] = times_moved  # all of the group moved: it stays as it is
    rank = [-1] * n
    free = list(range(n))
    placed = bytearray(n)
    rank[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        s = rank[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            rank[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = before[s]
    return rank
