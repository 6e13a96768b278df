"""Suffix arrays built one bucket at a time, with a difference cover for long ties.

D = {0, 1, 3} covers all differences modulo 7: for any two positions there is a shift d < 7 that moves both into the
sample {p : p mod 7 in D}. The sample's suffixes are ranked first, by prefix doubling in steps of 7, in which only ties
are sorted again. All other
suffixes are then sorted bucket by bucket (ranges of the first eight bytes): by those bytes, then, where they tie, by
residue; lists of the eight residues merge by ranks of sample positions, since after a tie of at least 7 bytes the
order of two suffixes is the order of the sample suffixes d further on. Beside the text and the ranks, memory holds
one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

V, D = 7, (0, 1, 3)
SHIFT = np.array([[min(d for d in range(V) if (r + d) % V in D and (s + d) % V in D) for s in range(V)] for r in range(V)])


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number; zeros beyond the end."""
    x = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | x[i : i + len(data)].astype(np.uint64)
    return out


def sample_ranks(data: np.ndarray, eight: np.ndarray) -> np.ndarray:
    """Ranks (from 1) of the sample positions, zero elsewhere."""
    n = len(data)
    place = np.flatnonzero(np.isin(np.arange(n) % V, D))
    rank = np.zeros(n + V + 1, np.int64)
    # seven bytes, and how many there are, so that an end sorts before a zero byte
    key = (eight[place] & ~np.uint64(0xFF)) | np.minimum(n - place, V).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    sorted_place, first = place[order], _run_starts(key[order])
    rank[sorted_place] = first + 1
    spot = np.flatnonzero(_tied(first))  # where in the order ties are left; only these are sorted again
    length = V
    while len(spot) and length < n:
        mine = sorted_place[spot]
        follow = np.where(mine + length < n, rank[np.minimum(mine + length, n)], 0)
        key = (first[spot].astype(np.uint64) << np.uint64(32)) | follow.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        # a group's members stay in its own stretch of the order
        sorted_place[spot] = mine[order]
        first[spot] = spot[_run_starts(key[order])]
        rank[sorted_place[spot]] = first[spot] + 1
        spot = spot[_tied(first[spot])]
        length *= 2
    return rank


def _run_starts(x: np.ndarray) -> np.ndarray:
    """For each place, where its run of equal values begins."""
    new = np.ones(len(x), np.bool_)
    new[1:] = x[1:] != x[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))


def _tied(first: np.ndarray) -> np.ndarray:
    same = first[1:] == first[:-1]
    out = np.zeros(len(first), np.bool_)
    out[1:] |= same
    out[:-1] |= same
    return out


def _sort_bucket(place: np.ndarray, eight: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    head = eight[place]
    order = np.argsort(head, kind="stable")
    place, head = place[order], head[order]
    new = np.concatenate([[True], head[1:] != head[:-1]])
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    tied = size[group] > 1
    if not tied.any():
        return place
    first = np.flatnonzero(new)
    t, g = place[tied], group[tied]
    top = np.int64(rank.max()) + 2
    # near the end of the text a suffix may be shorter than the shift: the shorter of two ties is the lesser
    ranked = lambda p, shift: np.where(p + shift < n, rank[np.minimum(p + shift, n)], n - 1 - (p + shift))
    value = lambda p, gg, shift: gg * (top + V + 1) + ranked(p, shift) + V
    residue = t % V
    lists = []
    for r in range(V):
        mine = np.flatnonzero(residue == r)
        lists.append(mine[np.argsort(value(t[mine], g[mine], SHIFT[r, r]), kind="stable")])
    before = np.zeros(len(t), np.int64)
    for r in range(V):
        mine = lists[r]
        if not len(mine):
            continue
        for s in range(V):
            other = lists[s]
            if not len(other):
                continue
            if r == s:
                # the place in one's own list within the tie group
                before[mine] += np.arange(len(mine)) - np.searchsorted(g[mine], g[mine], side="left")
                continue
            shift = SHIFT[r, s]
            side = "left" if r < s else "right"
            theirs = value(t[other], g[other], shift)
            at = np.searchsorted(theirs, value(t[mine], g[mine], shift), side=side)
            before[mine] += at - np.searchsorted(g[other], g[mine], side="left")
    out = place.copy()
    spot = first[g] + before
    out[spot] = t
    return out


def buckets(data: np.ndarray, places: np.ndarray, limit: int = 1 << 18) -> Iterator[np.ndarray]:
    """The given suffixes of data in lexicographic order, as one sorted piece a bucket of about `limit`."""
    if not len(places):
        return
    eight = words(data)
    rank = sample_ranks(data, eight)
    head = eight[places]
    n_buckets = max(1, -(-len(places) // limit))
    # splitters from evenly spaced suffixes; equal heads share a bucket
    some = np.sort(head[:: max(1, len(head) // (64 * n_buckets))])
    cuts = np.unique(some[(np.arange(1, n_buckets) * len(some)) // n_buckets])
    which = np.searchsorted(cuts, head, side="right")
    for b in range(len(cuts) + 1):
        mine = places[which == b]
        if len(mine):
            yield _sort_bucket(mine, eight, rank, len(data))


def suffix_array(data: bytes | np.ndarray, limit: int = 1 << 18) -> np.ndarray:
    """The whole suffix array."""
    x = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    return np.concatenate([np.zeros(0, np.int64), *buckets(x, np.arange(len(x)), limit)])
