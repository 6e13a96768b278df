"""Kernel sums over the contacts around places, one bin with its surroundings at a time.

A sum adds up what each end is away by itself, over contacts whose both ends are near. So for the ends of one side that
differ it is a product of a kernel matrix with the counts of contacts, and its running sums along the other side give the
sum for each place: the work grows with the ends that differ, not with pairs of places and contacts.
"""

from __future__ import annotations

import numpy as np

#: Numbers of a working matrix at most.
BLOCK = 1 << 21


def kernel(d: np.ndarray, separation: int, least: int) -> np.ndarray:
    return np.exp(-((np.maximum(np.abs(d), least) / (0.5 * separation)) ** 2))


def _along(q: np.ndarray, r: np.ndarray, p: np.ndarray, o: np.ndarray, w: np.ndarray, side: int, own: bool, separation: int, least: int, kernels: bool) -> list[np.ndarray]:
    """For places (q, r), q rising, over contacts (p, o) with counts w of one bin: how many are near, and the kernel sums of
    p - q below zero and above. `side` is the bin's step along r; in the own bin contacts count that differ in both ends."""
    out = [np.zeros(len(q)) for _ in range(3 if kernels else 1)]
    ends, at_p = np.unique(p, return_inverse=True)
    others, at_o = np.unique(o, return_inverse=True)
    order = np.argsort(at_o, kind="stable")
    starts = np.searchsorted(at_o[order], np.arange(len(others)))
    counts = None
    if len(ends) * len(others) <= min(BLOCK, 16 * len(w)):
        counts = np.zeros((len(ends), len(others)))
        np.add.at(counts, (at_p, at_o), w)
    places, first = np.unique(q, return_index=True)
    first = np.append(first, len(q))
    step = max(1, BLOCK // max(len(ends), len(others), 1 if counts is not None else len(w)))
    for i in range(0, len(places), step):
        rows = slice(first[i], first[min(i + step, len(places))])
        d = ends[None, :] - places[i : i + step, None]
        near = (d != 0) if own else np.abs(d) < separation
        parts = [near.astype(np.float64)]
        if kernels:
            k = kernel(d, separation, least)
            parts += [k * (near & (d < 0)), k * (near & (d >= 0))]
        at = np.searchsorted(places[i : i + step], q[rows])
        for total, part in zip(out, parts, strict=True):
            sums = part @ counts if counts is not None else np.add.reduceat(part[:, at_p[order]] * w[order], starts, axis=1)
            running = np.concatenate([np.zeros((len(sums), 1)), np.cumsum(sums, axis=1)], axis=1)
            every = running[at, -1]
            if own:
                k = np.minimum(np.searchsorted(others, r[rows]), len(others) - 1)
                total[rows] = every - np.where(others[k] == r[rows], sums[at, k], 0)
            elif side > 0:
                total[rows] = running[at, np.searchsorted(others, r[rows] + separation, "left")]
            elif side < 0:
                total[rows] = every - running[at, np.searchsorted(others, r[rows] - separation, "right")]
            else:
                total[rows] = every
    return out


def sums_around(a: np.ndarray, b: np.ndarray, contacts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]], separation: int, least: int, kernels: bool = True) -> tuple[np.ndarray, ...]:
    """(met, around, lo, hi) of places (a, b): contacts met in all bins and in those around the own one, and kernel sums below
    and above. contacts are (ends a, ends b, counts) by the bin's steps from the places' own bin."""
    met, around, lo, hi = (np.zeros(len(a)) for _ in range(4))
    by = [np.argsort(a, kind="stable"), np.argsort(b, kind="stable")]
    for (i, j), (p, o, w) in contacts.items():
        own = i == 0 and j == 0
        for x, order in enumerate(by if kernels else by[:1]):
            q, r, p_, o_, side = (a, b, p, o, j) if x == 0 else (b, a, o, p, i)
            got = _along(q[order], r[order], p_, o_, w, side, own, separation, least, kernels)
            if x == 0:
                n = np.rint(got[0])
                met[order] += n
                around[order] += 0 if own else n
            if kernels:
                lo[order] += np.maximum(got[1], 0)
                hi[order] += np.maximum(got[2], 0)
    return met, around, lo, hi
