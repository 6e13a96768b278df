"""Suffix-array dedup: removal of every byte inside a passage of `length` bytes that an earlier document has too.

A suffix array of the whole corpus would need several times the input on disk, so documents are first held against
each other by content-chosen anchors, and suffixes are sorted only where a passage can repeat:

1. In every window of `length` bytes the least hash among its k-grams is the window's anchor, so equal windows have
   equal anchors. All windows of one anchor are a stretch of bytes, its context. Batches send their distinct anchors
   (four bytes each); buckets answer which of them occur in more than one place.
2. For shared anchors, batches send their distinct contexts with the least doc_id of each. Where an earlier document
   has the whole context, all of its windows repeat. They also ask which anchors have several contexts.
3. The first document of each context can still share single windows with other contexts of its anchor, if there are
   any. The bytes of these contexts go to a bucket of suffixes, chosen by the anchor, from all batches. A bucket sorts its
   suffixes blockwise (`suffix_array.buckets`); neighbours in the order that agree in `length` bytes are a run, and a
   window of a run repeats where its document is not the run's first. Only the order and the bytes decide here.

Anchors are only a filter that never misses; whole contexts are told apart by 64-bit hashes. A passage that most documents
hold in equal surroundings costs each batch one entry a round. A known limit: a phrase shorter than `length` that stands in
ever different surroundings can be the anchor of as many contexts, and all contexts of an anchor go to one bucket.

Edge cases: doc_id is cast to long (an id that is no number fails or is null, by Spark's ANSI setting); a null text is empty; texts under `length` bytes lose nothing; a null doc_id counts as later than all
others; rows with equal doc_ids don't remove anything from each other; other columns are ignored by `removals`, and
travel with the rows through `rewrite`; an empty table has no rows in both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm import suffix_array
from contactloom.llm.common import (
    REQUEST,
    Batch,
    RollingHash,
    _powers,
    answers,
    batch_documents,
    buckets_for,
    deal,
    group_min,
    least_of,
    mix,
    pack,
    requests,
    trim,
    unpack,
)

LENGTH, K = 50, 34
BLOCK = 1 << 15
LAST = np.iinfo(np.int64).max


class Anchors:
    """The anchors of all windows of a batch. Windows first..last (starts) share the anchor `key`; `context` is the
    hash of their bytes; doc is the document's place and `id` its id."""

    def __init__(self, batch: Batch, length: int = LENGTH, k: int = K):
        data, n = batch.bytes, len(batch.text)
        self.batch, self.length = batch, length
        self.roll = RollingHash(data)
        self.ids = np.where(batch.null, LAST, batch.ids)
        wide = length - k + 1
        count = n - length + 1
        if count <= 0:
            z = np.zeros(0, np.int64)
            self.first = self.last = self.doc = self.id = z
            self.key = self.context = np.zeros(0, np.uint64)
            return
        bits = np.uint64(max(1, int(n).bit_length()))
        place_mask = (np.uint64(1) << bits) - np.uint64(1)
        at = np.empty(count, np.int64)
        sums, inverse = self.roll.sums, _powers(n + 1, self.roll.p, True)
        for lo in range(0, count, BLOCK):  # stretches that the processor's cache holds
            hi = min(count, lo + BLOCK)
            top = hi + wide - 1
            v = sums[lo + k : top + k] - sums[lo:top]
            v *= inverse[lo:top]
            # the upper bits of a multiplied hash order the k-grams; the place below makes the leftmost of equals the least
            v ^= v >> np.uint64(29)
            v *= np.uint64(0xBF58476D1CE4E5B9)
            v &= ~place_mask
            v |= np.arange(lo, top, dtype=np.uint64)
            span = 1
            while span * 2 <= wide:
                v = np.minimum(v[: len(v) - span], v[span:])
                span *= 2
            if span < wide:
                v = np.minimum(v[: hi - lo], v[wide - span : wide - span + hi - lo])
            at[lo:hi] = v[: hi - lo] & place_mask
        # starts of windows that leave their document
        short = np.minimum(batch.ends - batch.starts, length - 1)
        stop = np.cumsum(short)
        bad = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(batch.ends - stop, short)
        ok = np.ones(count, np.bool_)
        ok[bad[bad < count]] = False
        # a stretch ends where the anchor or the document changes; between documents there are invalid starts
        change = at[1:] != at[:-1]
        new, end = ok.copy(), ok.copy()
        new[1:] &= change | ~ok[:-1]
        end[:-1] &= change | ~ok[1:]
        self.first, self.last = np.flatnonzero(new), np.flatnonzero(end)
        self.doc = np.searchsorted(batch.ends, self.first, side="right")
        self.id = self.ids[self.doc]
        anchor = at[self.first]
        self.key = mix(self.roll.of(anchor, anchor + k))
        end = self.last + length
        self.context = mix(self.roll.of(self.first, end) + (end - self.first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + count[0] - 1, start[1] .., one after another."""
    stop = np.cumsum(count)
    return np.arange(int(stop[-1]) if len(stop) else 0, dtype=np.int64) + np.repeat(start - (stop - count), count)


def repeated_windows(text: bytes, sizes: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Flags of all windows of stretches that stand one after another in text, with `sizes` bytes each and the id of each:
    whether a stretch with a lesser id has the window too.

    Suffixes are sorted; neighbours with the same first `length` bytes are a run, which has the least id of its members.
    """
    data = np.frombuffer(text, np.uint8)
    count = sizes - length + 1
    starts = _ranges(np.cumsum(sizes) - sizes, count)
    mine = np.repeat(ids, count)
    least = mine.copy()
    back = np.zeros(len(data), np.int64)
    back[starts] = np.arange(len(starts))
    eight = suffix_array.words(data)
    offsets = [*range(0, length - 7, 8), length - 8]
    for piece in suffix_array.buckets(data, starts):
        new = np.zeros(len(piece), np.bool_)
        new[0] = True
        for o in offsets:
            w = eight[piece + o]
            new[1:] |= w[1:] != w[:-1]
        window = back[piece]
        low = np.minimum.reduceat(mine[window], np.flatnonzero(new))
        least[window] = low[np.cumsum(new) - 1]
    return least < mine


def _each(call: Callable[[int, bytes], pd.DataFrame]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for batch, blob in zip(f["batch"].tolist(), f["blob"], strict=True):
                yield call(batch, blob)
        trim()

    return run


def _answer_shared(asked: DataFrame) -> DataFrame:
    """Which anchors are in several batches, or in several documents of one."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b) for b in frame["blob"]]
        keys = np.concatenate([p["key"] for p in parts])
        _, place = np.unique(keys, return_inverse=True)
        shared = np.bincount(place, weights=1.0 + np.concatenate([p["several"] for p in parts]).astype(float))[place] >= 2
        rows, at = [], 0
        for p, batch in zip(parts, frame["batch"].tolist(), strict=True):
            n = len(p["key"])
            rows.append((int(frame["bucket"].iloc[0]), batch, pack(shared=np.packbits(shared[at : at + n]))))
            at += n
        return pd.DataFrame(rows, columns=["bucket", "batch", "blob"])

    return asked.groupBy("bucket").applyInPandas(run, REQUEST)


def _answer_contexts(asked: DataFrame, n: int) -> DataFrame:
    """Buckets under n: the least doc_id of each context. The others: whether an anchor has several contexts."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(frame["bucket"].iloc[0])
        if bucket < n:
            return least_of(frame)
        parts = [unpack(b) for b in frame["blob"]]
        keys = np.concatenate([p["key"] for p in parts])
        _, place, low, high = group_min(keys, np.concatenate([p["digest"] for p in parts]))
        many = np.bincount(place, weights=np.concatenate([p["several"] for p in parts])) > 0
        several = ((low < high) | many)[place]
        rows, at = [], 0
        for p, batch in zip(parts, frame["batch"].tolist(), strict=True):
            size = len(p["key"])
            rows.append((bucket, batch, pack(several=np.packbits(several[at : at + size]))))
            at += size
        return pd.DataFrame(rows, columns=["bucket", "batch", "blob"])

    return asked.groupBy("bucket").applyInPandas(run, REQUEST)


def _answer_windows(asked: DataFrame, length: int) -> DataFrame:
    """For each stretch sent, which of its windows an earlier document has."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b) for b in frame["blob"]]
        sizes = [p["size"].astype(np.int64) for p in parts]
        flags = repeated_windows(b"".join(p["text"] for p in parts), np.concatenate(sizes), np.concatenate([p["id"] for p in parts]), length)
        rows, at = [], 0
        for size, bucket, batch in zip(sizes, frame["bucket"].tolist(), frame["batch"].tolist(), strict=True):
            n = int((size - length + 1).sum())
            rows.append((bucket, batch, pack(bits=np.packbits(flags[at : at + n]))))
            at += n
        trim()
        return pd.DataFrame(rows, columns=["bucket", "batch", "blob"])

    return asked.groupBy("bucket").applyInPandas(run, REQUEST)


class _State:
    """What a batch knows after the rounds answered so far. rows: (round, bucket, blob)."""

    def __init__(self, blob: bytes, rows: pd.DataFrame, n: int, length: int, k: int):
        self.a = a = Anchors(Batch(blob), length, k)
        got = {r: x for r, x in rows.groupby("round")}
        none = rows.iloc[:0]
        keys, place, _, _ = group_min(a.key, a.id)
        shared = answers(keys, n, got.get(1, none), "shared", np.bool_)[place]
        self.chosen = np.flatnonzero(shared)
        self.contexts, self.place, self.least, _ = group_min(a.context[self.chosen], a.id[self.chosen])
        self.anchors, anchor_place, self.low, self.high = group_min(a.key[self.chosen], a.context[self.chosen])
        if 2 in got or not len(self.contexts):
            two = got.get(2, none)
            first = answers(self.contexts, n, two[two["bucket"] < n], "least", np.int64)[self.place]
            other = two[two["bucket"] >= n].assign(bucket=lambda x: x["bucket"] - n)
            several = answers(self.anchors, n, other, "several", np.bool_)[anchor_place]
            later = first < a.id[self.chosen]
            self.repeated = self.chosen[later]
            self.own = self.chosen[~later & several]
            # one stretch for each distinct context; a context's stretches here are all of its first document
            _, self.rep, self.of = np.unique(a.context[self.own], return_index=True, return_inverse=True)
            self.rep = self.own[self.rep]
        self.later = np.zeros(0, np.int64)
        if 3 in got and len(self.own):
            order, bounds = deal(a.key[self.rep], n)
            count = (a.last - a.first + 1)[self.rep]
            offset = np.cumsum(count) - count
            flags = np.zeros(int(count.sum()), np.bool_)
            for b, blob in zip(got[3]["bucket"].tolist(), got[3]["blob"], strict=True):
                at = _ranges(offset[order[bounds[b] : bounds[b + 1]]], count[order[bounds[b] : bounds[b + 1]]])
                flags[at] = np.unpackbits(unpack(blob)["bits"])[: len(at)]
            hit = flags[_ranges(offset[self.of], count[self.of])]
            self.later = _ranges(a.first[self.own], count[self.of])[hit]

    def stretches(self, batch: int, n: int) -> pd.DataFrame:
        """(bucket, batch, blob): bytes, sizes and ids of the stretches whose windows have to be sorted."""
        a = self.a
        order, bounds = deal(a.key[self.rep], n)
        rows = []
        for b in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            part = self.rep[order[bounds[b] : bounds[b + 1]]]
            first, end = a.first[part], a.last[part] + a.length
            rows.append((b, batch, pack(size=(end - first).astype(np.uint32), id=a.id[part], text=a.batch.bytes[_ranges(first, end - first)].tobytes())))
        return pd.DataFrame(rows, columns=["bucket", "batch", "blob"])

    def removed(self) -> np.ndarray:
        """Flags over all bytes of the batch."""
        a, n = self.a, len(self.a.batch.text)
        change = np.zeros(n + 1, np.int32)
        if len(a.first):
            np.add.at(change, a.first[self.repeated], 1)
            np.add.at(change, a.last[self.repeated] + a.length, -1)
            np.add.at(change, self.later, 1)
            np.add.at(change, self.later + a.length, -1)
        return np.cumsum(change)[:n] > 0


def _with_answers(batches: DataFrame, replies: list[DataFrame], call: Callable[[int, bytes, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """call(batch, blob, rows (round, bucket, blob)) for each batch."""
    told = None
    for i, r in enumerate(replies, 1):
        x = r.select("batch", F.lit(i).alias("round"), "bucket", "blob")
        told = x if told is None else told.unionByName(x)

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        frames = [call(b, blob, right) for b, blob in zip(left["batch"].tolist(), left["blob"], strict=True)]
        trim()
        return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])

    return batches.groupBy("batch").cogroup(told.groupBy("batch")).applyInPandas(run, schema)


def removals(spark: SparkSession, docs: DataFrame, each: Callable[[Batch, np.ndarray], pd.DataFrame], schema: str, length: int = LENGTH, k: int = K, others: Sequence[str] = ()) -> DataFrame:
    """Rows made by `each` from every batch and the flags of its removed bytes."""
    batches = batch_documents(spark, docs, others=others)
    n = buckets_for(spark, batches)

    def ask_anchors(batch: int, blob: bytes) -> pd.DataFrame:
        a = Anchors(Batch(blob), length, k)
        keys, _, least, most = group_min(a.key, a.id)
        # two keys of a bucket that agree in what is sent only cost later rounds work
        return requests(batch, keys, n, short=True, several=least < most)

    def ask_contexts(batch: int, blob: bytes, rows: pd.DataFrame) -> pd.DataFrame:
        s = _State(blob, rows, n, length, k)
        other = requests(batch, s.anchors, n, short=True, digest=s.low, several=s.low < s.high)
        other["bucket"] += n
        return pd.concat([requests(batch, s.contexts, n, value=s.least), other], ignore_index=True)

    def ask_windows(batch: int, blob: bytes, rows: pd.DataFrame) -> pd.DataFrame:
        s = _State(blob, rows, n, length, k)
        return s.stretches(batch, n)

    def finish(batch: int, blob: bytes, rows: pd.DataFrame) -> pd.DataFrame:
        s = _State(blob, rows, n, length, k)
        return each(s.a.batch, s.removed() if len(s.contexts) else np.zeros(len(s.a.batch.text), np.bool_))

    shared = _answer_shared(batches.mapInPandas(_each(ask_anchors), REQUEST))
    contexts = _answer_contexts(_with_answers(batches, [shared], ask_contexts, REQUEST), n)
    windows = _answer_windows(_with_answers(batches, [shared, contexts], ask_windows, REQUEST), length)
    return _with_answers(batches, [shared, contexts, windows], finish, schema)


def digests(batch: Batch, removed: np.ndarray) -> pd.DataFrame:
    data = batch.bytes
    rows = []
    for a, b in zip(batch.starts.tolist(), batch.ends.tolist(), strict=True):
        r = removed[a:b]
        gone = int(r.sum())
        spans = int(r[0]) + int((r[1:] & ~r[:-1]).sum()) if gone else 0
        left = data[a:b][~r].tobytes() if gone else batch.text[a:b]
        rows.append((b - a, gone, spans, hashlib.sha256(left).hexdigest()))
    out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
    out.insert(0, "doc_id", batch.id_column())
    return out


def rewrite(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with repeated passages taken out of `text` and `n_chars` set to what is left; rows of which no word is
    left go. A character stays unless all of its bytes are removed."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    kinds, names = dict(docs.dtypes), docs.columns
    schema = ", ".join(f"`{c}` {'bigint' if c in ('doc_id', 'n_chars') else kinds[c]}" for c in docs.columns)

    def each(batch: Batch, removed: np.ndarray) -> pd.DataFrame:
        data = batch.bytes
        head = (data & 0xC0) != 0x80  # first bytes of characters
        keep = np.zeros(len(data), np.bool_)
        if len(data):
            char = np.cumsum(head) - 1
            keep = (np.bincount(char, weights=~removed) > 0)[char]
        texts, rows = [], []
        for i, (a, b) in enumerate(zip(batch.starts.tolist(), batch.ends.tolist(), strict=True)):
            text = data[a:b][keep[a:b]].tobytes() if removed[a:b].any() else batch.text[a:b]
            if text == batch.text[a:b] or text.strip():
                rows.append(i)
                texts.append(text.decode())
        out = batch.others() if others else pd.DataFrame(index=range(batch.n))
        out = out.iloc[rows].reset_index(drop=True)
        out["doc_id"] = batch.id_column().iloc[rows].reset_index(drop=True)
        out["text"] = pd.Series(texts, dtype=object)
        if "n_chars" in names:
            out["n_chars"] = np.array([len(t) for t in texts], np.int64)
        return out[names]

    return removals(spark, docs, each, schema, others=others)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: what is left of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return removals(spark, docs, digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
