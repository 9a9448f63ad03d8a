"""Suffix arrays by linear grouping.

Suffixes are first grouped by their first symbol. Groups are processed in descending order: each
suffix of the group points to its previous smaller suffix, the nearest one before it in a lower
group, and suffixes that are pointed to leave their group for a new one right behind it, the
higher the more pointers they got. In the end the suffixes of a group share their longest Lyndon
prefix. A second pass in ascending order then emits each group's order: the suffixes whose Lyndon
prefix ends where the next suffix in order begins are a chain of previous-smaller pointers, and
take the next place of their groups. Nothing is renamed and nothing recurses.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of text in order; the last symbol must be smaller than all others."""
    n = len(text)
    if n < 2:
        return list(range(n))
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start, last = 0, None
    for at, i in enumerate(order):
        place[i] = at
        if text[i] != last:
            start, last = at, text[i]
        group[i] = start
        size[start] += 1
    before = [-1] * n

    end = n
    while end:
        low = group[order[end - 1]]
        members = order[low:end]
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            if len(pointed) == 1:
                rounds = [list(pointed)]
            else:
                counts = set(pointed.values())
                rounds = [list(pointed)] if len(counts) == 1 else [[j for j, c in pointed.items() if c == count] for count in sorted(counts, reverse=True)]
            for chosen in rounds:
                moved: dict[int, int] = {}
                for j in chosen:  # to the end of its group
                    g = group[j]
                    took = moved[g] = moved.get(g, 0) + 1
                    target = g + size[g] - took
                    other, own = order[target], place[j]
                    order[target], order[own] = j, other
                    place[j], place[other] = target, own
                for g, took in moved.items():
                    size[g] -= took
                for j in chosen:
                    g = group[j]
                    fresh = g + size[g]
                    group[j] = fresh
                for g, took in moved.items():
                    if size[g]:
                        size[g + size[g]] = took
                    else:
                        size[g] = took
        end = low

    found, done = [-1] * n, [False] * n
    found[0] = n - 1
    done[n - 1] = True
    free = list(range(n))  # next place of each group, by the group's start
    for at in range(n):
        j = found[at] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            found[free[g]] = j
            free[g] += 1
            done[j] = True
            j = before[j]
    return found
