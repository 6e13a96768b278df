"""Periodic run detection: maximal stretches of words that repeat with a period, and texts with the repeats collapsed.

The ids of a text's words (dense numbers within the text) are held as bit planes, big integers of one bit a word. For a
lag q every plane is XORed with itself shifted by q, and the results are ORed: a zero bit says that the words at i and
i + q are equal. A run of period q and length l is a stretch of l - q such zeros, so it is long enough where a stretch has
at least max(12 - q, q) of them. Those stretches are isolated by ANDs of the matches with themselves, shifted by doubled
distances.

Lags under 64 are tried on the whole text. Of longer lags only those that can hold a run are tried, and only around it: a
stretch of q matches covers a whole block of L words that begins at a multiple of L, for any L up to q / 2, so with
L = 32, 64, ... and lags of 2L to 4L a lag is tried where the rolling hash of a block equals that of the words q further on.
Hashes only propose: bit planes decide. Blocks that lie in a known run whose period divides q show no new run. So a
text of n words costs about n log n steps, whatever its words are; one word repeated a million times too.

Edge cases: a null or empty text has no words and no runs, and its collapsed text is empty; repeated rows give repeated
results; a null doc_id stays null; the order of rows does not matter; columns besides doc_id and text are not read. An
empty table gives an empty one. Any doc_id type is kept by `find_runs`; the query casts it to long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.units import chunks

#: A run has at least so many words (and two periods).
LEAST = 12
#: Lags below this are tried on whole texts; a power of two.
DIRECT = 64

WORD = r"[^\x20\x09-\x0D]+"
RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def word_ids(words: list) -> np.ndarray:
    """Dense numbers of words, equal for equal ones."""
    known: dict = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def bit_planes(ids: np.ndarray) -> list[int]:
    """Big integers: bit i of plane k is bit k of ids[i]."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    return [int.from_bytes(np.packbits((ids >> k).astype(np.uint8) & 1, bitorder="little").tobytes(), "little") for k in range(top)]


def matches(planes: list[int], n: int, lag: int) -> int:
    """Bit i is set where the words at i and i + lag are equal, i < n - lag."""
    differ = 0
    for p in planes:
        differ |= p ^ (p >> lag)
    return ~differ & ((1 << (n - lag)) - 1)


def stretch_starts(bits: int, least: int) -> int:
    """Bit i is set where bits i .. i + least - 1 all are: ANDs with shifts that double."""
    have = 1
    while have < least and bits:
        step = min(have, least - have)
        bits &= bits >> step
        have += step
    return bits


def stretches(bits: int, least: int) -> list[tuple[int, int]]:
    """(begin, end) of the maximal stretches of at least `least` set bits."""
    begun = stretch_starts(bits, least)
    if not begun:
        return []
    row = np.frombuffer(begun.to_bytes((begun.bit_length() + 7) // 8, "little"), np.uint8)
    on = np.unpackbits(row, bitorder="little").astype(np.int8)
    edge = np.flatnonzero(np.diff(on, prepend=0, append=0))
    return [(a, b + least - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    p = 0x9E3779B97F4A7C15
    up, down = np.full(n, p, np.uint64), np.full(n, pow(p, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class _Hashes:
    """Rolling hashes of word ids: equal for equal stretches, and rarely for others."""

    def __init__(self, ids: np.ndarray):
        size = 1 << max(len(ids) + 1, 2).bit_length()
        up, self.down = _powers(size)
        # spread ids over 64 bits first, so that sums of small numbers don't meet
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[: len(ids)], dtype=np.uint64)])

    def of(self, length: int) -> np.ndarray:
        """Of the stretches of `length` words at 0, 1, ..."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n] if n > 0 else np.zeros(0, np.uint64)


def _likely(hashes: np.ndarray, n: int, block: int, runs: dict[tuple[int, int], int]) -> Iterator[tuple[int, int, int]]:
    """(lag, begin, end): lags from 2 * block to 4 * block - 1, and words begin .. end - 1 between whose words and those a
    lag further on all long stretches of matches lie."""
    blocks = np.arange(0, max(len(hashes) - 2 * block, 0), block)
    if not len(blocks):
        return
    padded = np.concatenate([hashes, np.zeros(4 * block, np.uint64)])
    equal = sliding_window_view(padded, 2 * block)[blocks + 2 * block] == hashes[blocks][:, None]
    lags = np.arange(2 * block, 4 * block)
    equal &= blocks[:, None] + lags[None, :] < len(hashes)
    equal &= 2 * lags[None, :] <= n
    for (start, end), period in runs.items():
        if end - start >= 3 * block:
            first = -(-2 * block // period) * period - 2 * block
            a, b = -(-start // block), (end - 1) // block + 1
            inside = blocks[a:b, None] + block + lags[None, first::period] <= end
            equal[a:b, first::period] &= ~inside
    which, lag = np.nonzero(equal.T)[::-1]
    if not len(which):
        return
    cut = np.flatnonzero((np.diff(lag) != 0) | (np.diff(which) > 1)) + 1
    for a, b in pairwise([0, *cut.tolist(), len(which)]):
        yield int(lag[a]) + 2 * block, max((int(which[a]) - 1) * block, 0), (int(which[b - 1]) + 2) * block


def find(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs, by start, then period. Periods are smallest ones."""
    n = len(ids)
    runs: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period; longer periods of the same stretch come later

    def keep(begin: int, bits: int, lag: int) -> None:
        for a, b in stretches(bits, max(least - lag, lag)):
            runs.setdefault((begin + a, begin + b + lag), lag)

    if n < least:
        return []
    planes = bit_planes(ids)
    for lag in range(1, min(DIRECT, n // 2 + 1)):
        keep(0, matches(planes, n, lag), lag)
    if n >= 2 * DIRECT:
        hashes, block = _Hashes(ids), DIRECT // 2
        while 4 * block <= n:
            for lag, begin, end in _likely(hashes.of(block), n, block, runs):
                part = ids[begin : min(end + lag, n)]
                # dense numbers again: a part needs as many planes as it has different words
                part = np.unique(part, return_inverse=True)[1]
                keep(begin, matches(bit_planes(part), len(part), lag), lag)
            block *= 2
    return sorted((a, b - a, q) for (a, b), q in runs.items())


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when every run loses what follows its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] == 0


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed) of all rows of docs (doc_id, text).

    Words are runs of characters other than ASCII white space; `collapsed` is the words that stay, joined by one space.
    A text is read whole in one task; rows stay where they are.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in chunks(batch):
                counts, found, texts = [], [], []
                for text in rows.column("text").to_pylist():
                    words = text.encode().split()  # bytes split at just the six white-space bytes
                    got = find(word_ids(words), least)
                    counts.append(len(words))
                    found.append([{"start": a, "length": b, "period": q} for a, b, q in got])
                    if got:
                        words = [w for w, k in zip(words, kept(len(words), got).tolist(), strict=True) if k]
                    texts.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, RUN), pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def with_planted(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with a repeating end in each text whose id's checksum is a multiple of ten."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_h", F.coalesce(h, F.lit(1))).withColumn("_g", F.floor(F.col("_h") / 10))
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, words))
    n = F.size("_w")

    def looped() -> Column:
        a = (F.col("_g") % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int")
        tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get("_w", a + i % p))
        return F.concat(F.slice("_w", F.lit(1), a), tail)

    return rows.select("doc_id", F.when((F.col("_h") % 10 == 0) & (n > 0), F.array_join(looped(), " ")).otherwise(F.col("text")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the runs of every whole document, of which a tenth get a repeating end, as digests."""
    found = find_runs(with_planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    text = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    # greatest length, then smallest start and period: greatest by (length, -start, -period)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
