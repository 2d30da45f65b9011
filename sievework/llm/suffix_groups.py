"""Suffix arrays by grouping: Lyndon-prefix groups in descending order, then each group's order."""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(symbols: Sequence[int]) -> tuple[list[int], list[int]]:
    """(group of each suffix, previous smaller suffix of each, -1 for none).

    Suffixes with the same Lyndon prefix share a group; a group is named by its first place in the suffix
    array. At first suffixes are grouped by their first symbol. Groups are taken in descending order; all suffixes
    that were taken leave a linked list of positions, so the left neighbour in it is the previous smaller suffix. The Lyndon
    prefix of that one goes on with the group's, so it moves up within its own group: behind those that
    go on with it less often and before those already moved.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place = [0] * n
    group = [0] * n
    size: dict[int, int] = {}
    start = 0
    for k, i in enumerate(order):
        if k and symbols[i] != symbols[order[k - 1]]:
            start = k
        place[i], group[i] = k, start
        size[start] = size.get(start, 0) + 1
    left, right = list(range(-1, n)), list(range(1, n + 2))  # of position i at i; -1 is the list's end
    smaller = [-1] * n
    end = n
    while end > 0:
        start = group[order[end - 1]]
        members = sorted(order[start:end])
        times: dict[int, int] = {}
        for i in members:
            before, after = left[i], right[i]
            if before >= 0:
                right[before] = after
            left[after] = before
            smaller[i] = before
            if before >= 0:
                times[before] = times.get(before, 0) + 1
        levels: dict[int, list[int]] = {}
        for i, count in times.items():
            levels.setdefault(count, []).append(i)
        for count in sorted(levels, reverse=True):
            for i in levels[count]:
                size[group[i]] -= 1
                last = group[i] + size[group[i]]
                j, k = order[last], place[i]
                order[last], order[k] = i, j
                place[i], place[j] = last, k
            moved = [(i, group[i] + size[group[i]]) for i in levels[count]]
            for i, new in moved:
                group[i] = new
            for _, new in moved:
                size[new] = 0
            for _, new in moved:
                size[new] += 1
        end = start
    return group, smaller


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Start positions of all suffixes in ascending order, in linear time after the sort of the symbols; the end counts as smallest.

    Within a group suffixes differ only from the next smaller suffix on. Going up the array, each suffix
    places those whose next smaller suffix it is - the chain of previous smaller pointers from its left
    neighbour - at the front of their groups.
    """
    group, smaller = lyndon_groups(symbols)
    n = len(symbols)
    found, front = [0] * n, list(range(n))
    at, stop = n - 1, -1
    k = 0
    while True:
        while at != stop:
            g = group[at]
            found[front[g]] = at
            front[g] += 1
            at = smaller[at]
        if k == n:
            return found
        at, stop = found[k] - 1, smaller[found[k]]
        k += 1


def longest_matches(symbols: Sequence[int], array: Sequence[int]) -> list[int]:
    """For every position, how many symbols from it on also begin somewhere else, from neighbours in the array."""
    n = len(symbols)
    place = [0] * n
    for k, i in enumerate(array):
        place[i] = k
    best = [0] * n
    h = 0
    for i in range(n):
        k = place[i]
        if k == 0:
            h = 0
            continue
        j = array[k - 1]
        while i + h < n and j + h < n and symbols[i + h] == symbols[j + h]:
            h += 1
        best[i] = max(best[i], h)
        best[j] = max(best[j], h)
        h = max(h - 1, 0)
    return best
