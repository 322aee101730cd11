"""Linear-time suffix sorting by grouping (Baier, 2016): no recursion, no renaming.

Phase 1 keeps the suffixes in groups ordered by their Lyndon prefixes and processes the groups from the greatest down. A
suffix's pointer goes to the nearest suffix before it in a smaller group; suffixes that are pointed at by more members of
the group move further up within their own. Phase 2 runs over the result from the left and puts each suffix's predecessor,
and those along its pointers, at the front of what is left of its group.
"""

from __future__ import annotations

from itertools import groupby


def suffix_array(symbols: bytes | list[int]) -> list[int]:
    """Start of each suffix in lexicographic order; a suffix that is a prefix of another comes before it."""
    s = [x + 1 for x in symbols]
    s.append(0)
    n = len(s)
    sa = sorted(range(n), key=s.__getitem__)
    at = [0] * n  # place of each suffix in sa
    group = [0] * n  # first place of its group
    size = [0] * n  # of the group that begins at a place
    begin = 0
    for i, x in enumerate(sa):
        if s[x] != s[sa[begin]]:
            begin = i
        at[x] = i
        group[x] = begin
        size[begin] += 1
    prev = [-1] * n
    end = n - 1
    while end > 0:
        start = group[sa[end]]
        members = sa[start : end + 1]
        end = start - 1
        if len(members) > 1:
            members.sort()
            children: dict[int, int] = {}
            for x in members:
                p = x - 1
                while p >= 0 and group[p] >= start:
                    p = prev[p]
                prev[x] = p
                if p >= 0:
                    children[p] = children.get(p, 0) + 1
            if len(children) > 1 and max(children.values()) > 1:
                rounds = [[p for p, _ in g] for _, g in groupby(sorted(children.items(), key=lambda c: -c[1]), key=lambda c: c[1])]
            else:
                rounds = [list(children)]
        else:
            x = members[0]
            p = x - 1
            while p >= 0 and group[p] >= start:
                p = prev[p]
            prev[x] = p
            if p < 0:
                continue
            rounds = [[p]]
        for parents in rounds:
            moved: dict[int, int] = {}
            for p in parents:  # to the end of their old group
                g = group[p]
                m = moved.get(g, 0) + 1
                moved[g] = m
                to = g + size[g] - m
                here = at[p]
                if to != here:
                    q = sa[to]
                    sa[to], sa[here] = p, q
                    at[p], at[q] = to, here
            for g, m in moved.items():
                old = size[g]
                if m < old:
                    size[g] = old - m
                    new = g + old - m
                    size[new] = m
                    for x in sa[new : new + m]:
                        group[x] = new
    out = [-1] * n
    out[0] = n - 1
    front = list(range(n))
    placed = bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            placed[j] = 1
            j = prev[j]
    return out[1:]
