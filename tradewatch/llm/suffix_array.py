"""Suffix array of one sequence by grouping suffixes on their Lyndon prefixes, without recursion.

A suffix's Lyndon prefix reaches up to the next smaller suffix. First, suffixes are grouped by it:
groups start as those of equal first symbols and are taken in descending order; each suffix of the
taken group points back to the nearest earlier suffix of a lower group, whose own prefix then goes on
with the group's as often as the group's suffixes follow one another, so that it moves to a new group
right behind its old one, the higher the more repeats. Then every suffix, in ascending order, names
the suffixes whose prefix ends where it starts: the one before it and on along the pointers; each is
the next smallest of its group. Both passes are linear in the length.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> list[int]:
    """Starts of all suffixes in ascending order; ``symbols`` are whole numbers of 0 or more, any length."""
    n = len(symbols) + 1
    order, place, group, size = _by_first_symbol(np.append(np.asarray(symbols, np.int64) + 1, 0))
    before = _group_by_lyndon_prefix(n, order, place, group, size)
    return _emit(n, group, before)[1:]


def _by_first_symbol(t: np.ndarray) -> tuple[list, list, list, list]:
    """(suffixes by group, place of each in that order, first place of each one's group, size of the group at a place)."""
    order = np.argsort(t, kind="stable")
    ranked = t[order]
    first = np.searchsorted(ranked, ranked, "left")
    place, group, size = (np.empty(len(t), np.int64) for _ in range(3))
    place[order] = np.arange(len(t))
    group[order] = first
    size[:] = np.bincount(first, minlength=len(t))
    return order.tolist(), place.tolist(), group.tolist(), size.tolist()


def _group_by_lyndon_prefix(n: int, order: list, place: list, group: list, size: list) -> list:
    """Refines the groups; returns for every suffix the nearest earlier one of a lower group, -1 if none."""
    before = [-1] * n
    end = n
    while end > 0:
        g = group[order[end - 1]]
        if end - g == 1:  # the common case: one suffix moves at most
            s = order[g]
            p = s - 1
            while p >= 0 and group[p] > g:
                p = before[p]
            before[s] = p
            if p >= 0:
                old = group[p]
                size[old] -= 1
                to = old + size[old]
                at = place[p]
                if at != to:
                    other = order[to]
                    order[at], order[to] = other, p
                    place[other], place[p] = at, to
                group[p] = to
                size[to] = 1
            end = g
            continue
        for pointed in _repeats(order[g:end], g, group, before):
            # To the end of their groups, then into new groups there.
            for p in pointed:
                old = group[p]
                size[old] -= 1
                to, at = old + size[old], place[p]
                other = order[to]
                order[at], order[to] = other, p
                place[other], place[p] = at, to
            starts = [group[p] + size[group[p]] for p in pointed]
            for p, start in zip(pointed, starts):
                group[p] = start
                size[start] += 1
        end = g
    return before


def _repeats(members: list, g: int, group: list, before: list) -> list[list]:
    """Points the members back; the lower suffixes pointed to, those with most repeats of the prefix first."""
    members = sorted(members)
    heads: list[list] = []  # [lower suffix, repeats]
    for s in members:
        p = s - 1
        while p >= 0 and group[p] > g:
            p = before[p]
        if p >= 0 and group[p] == g:  # the prefix follows itself
            before[s] = before[p]
            heads[-1][1] += 1
        else:
            before[s] = p
            heads.append([p, 1])
    by_count: dict[int, list] = {}
    for p, k in heads:
        if p >= 0:
            by_count.setdefault(k, []).append(p)
    return [by_count[k] for k in sorted(by_count, reverse=True)]


def _emit(n: int, group: list, before: list) -> list:
    """The order inside the groups, from the smallest suffix up."""
    out, front, placed = [0] * n, list(range(n)), [False] * n
    out[0] = n - 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[front[g]] = s
            front[g] += 1
            placed[s] = True
            s = before[s]
    return out
