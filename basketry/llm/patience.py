"""Patience alignment of two sequences, shared by the line and the license operator."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Hashable, Sequence


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        at = bisect_left(tails, v)
        before[i] = ends[at - 1] if at else -1
        tails[at : at + 1] = [v]
        ends[at : at + 1] = [i]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def align(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Pairs of places with equal items, increasing in both.

    Equal items at both ends are paired; of the rest, those that occur once in each side are anchors, of
    which the longest increasing subsequence is kept; the gaps between anchors are aligned alike. A gap
    without anchors stays open.
    """
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        once = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place]
        if not once:
            continue
        anchors = [once[k] for k in longest_increasing([j for _, j in once])]
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        gaps += [
            (i + 1, k, j + 1, m)
            for (i, j), (k, m) in zip(edges, edges[1:], strict=False)
            if k > i + 1 and m > j + 1
        ]
    return sorted(out)
