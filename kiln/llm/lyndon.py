"""Suffix array by Lyndon grouping: linear, without recursion or renaming.

Suffixes that share their Lyndon prefix (the longest Lyndon word they start
with) form a group. Groups are taken in descending order. For every member the
previous-smaller pointer gives the nearest earlier suffix of a lower group;
that suffix's Lyndon prefix goes on with the member's, so it leaves its group
for a new one directly above, the higher the more members point to it. When
all groups are fixed, suffixes are emitted in order: behind each emitted
suffix, the ones whose Lyndon prefix ends there take the next places of their
groups, found along the same pointers.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """Order of the suffixes of a sequence of integers (a suffix goes before those it is a prefix of)."""
    n = len(text)
    if not n:
        return []
    group, members, previous, ascending = _lyndon_groups(text)
    return _emitted(n, group, members, previous, ascending)


def _lyndon_groups(text: np.ndarray) -> tuple[list[int], list[list[int]], list[int], list[int]]:
    n = len(text)
    values, first_group = np.unique(text, return_inverse=True)
    count = len(values)
    members = [m.tolist() for m in np.split(np.argsort(first_group, kind="stable"),
                                            np.cumsum(np.bincount(first_group))[:-1])]
    group = first_group.tolist()
    lower = list(range(-1, count - 1))
    upper = [*range(1, count), -1]
    done = [False] * count
    previous = [-1] * n
    descending = []
    g = count - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        done[g] = True  # the walks below pass over the group's own members as over higher ones
        if len(own) == 1:  # the same as below for the many groups of one member
            descending.append(g)
            i = own[0]
            p = i - 1
            while p >= 0 and done[group[p]]:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                h, new = group[p], len(members)
                members.append([p])
                done.append(False)
                lower.append(h)
                above = upper[h]
                upper.append(above)
                if above >= 0:
                    lower[above] = new
                upper[h] = new
                group[p] = new
            g = lower[g]
            continue
        own.sort()
        points: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and done[group[p]]:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                points[p] = points.get(p, 0) + 1
        descending.append(g)
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in points.items():
            moved.setdefault((-times, group[p]), []).append(p)
        for key in sorted(moved) if len(moved) > 1 else moved:
            h, new = key[1], len(members)
            members.append(moved[key])
            done.append(False)
            lower.append(h)
            upper.append(upper[h])
            if upper[h] >= 0:
                lower[upper[h]] = new
            upper[h] = new
            for p in moved[key]:
                group[p] = new
        g = lower[g]
    return group, members, previous, descending[::-1]


def _emitted(n: int, group: list[int], members: list[list[int]], previous: list[int], ascending: list[int]) -> list[int]:
    place = [0] * len(members)
    at = 0
    for g in ascending:
        place[g] = at
        at += len(members[g])
    order = [-1] * n
    placed = [False] * n
    for k in range(-1, n):
        j = (order[k] if k >= 0 else n) - 1  # behind the empty suffix first
        while j >= 0 and not placed[j]:
            g = group[j]
            order[place[g]] = j
            place[g] += 1
            placed[j] = True
            j = previous[j]
    return order
