"""Encoding texts by their units: each distinct unit of a chunk is encoded once, then looked up by place.

Some tokenizers never merge across certain boundaries (white space, say). There the ids of a text are the ids of its
units, one after another. Units are cut and numbered by Arrow's kernels; only units not met before are encoded. An
encoder lives as long as its Python worker, so what one task has met the next one knows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units, and characters of units, that a worker keeps; the store is emptied when it is full.
STORE, STORE_CHARS = 1_000_000, 16_000_000
#: Bytes of text that are encoded at once.
CHUNK = 6 << 20


class UnitEncoder:
    """ids of texts. `cut(array) -> list array of units`; `encode(units) -> one list of ids a unit`; `store`: units kept."""

    def __init__(self, cut: Callable[[pa.Array], pa.ListArray], encode: Callable[[list[str]], Sequence[Sequence[int]]], store: int = STORE):
        self.cut, self.encode, self.store = cut, encode, store
        self._start()

    def _start(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.first = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _numbers(self, units: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        missing = at < 0
        new = list(compress(units, missing.tolist()))
        if new:
            self.chars += sum(map(len, new))
            ids = self.encode(new)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            base = len(self.first) - 1
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size)])
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
            self.flat = np.concatenate([self.flat, flat])
            numbers = range(base, base + len(new))
            self.known.update(zip(new, numbers, strict=True))
            at[missing] = numbers
        return at

    def __call__(self, texts: pa.Array | Sequence[str]) -> Iterator[np.ndarray]:
        """ids of each text, in order."""
        if len(self.known) > self.store or self.chars > STORE_CHARS:
            self._start()
        units = self.cut(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        ends = units.offsets.to_numpy()
        coded = pc.dictionary_encode(units.values.slice(int(ends[0]), int(ends[-1] - ends[0])))
        numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        ends = ends - ends[0]
        size = (self.first[1:] - self.first[:-1])[numbers]
        stop = np.cumsum(size)
        # places in `flat` of all ids: for each unit first[number], first[number] + 1, ...
        total = int(stop[-1]) if len(stop) else 0
        place = np.arange(total, dtype=np.int64) + np.repeat(self.first[numbers] - (stop - size), size)
        ids = self.flat[place]
        bound = np.concatenate([np.zeros(1, np.int64), stop])[ends]
        for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
            yield ids[a:b]


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each, to bound memory."""
    part = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
