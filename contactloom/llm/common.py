"""What the operators share: the common folder, written intermediate tables, and batches of documents.

A *batch* is one row that holds some megabytes of documents as one compressed value. Operators that compare
documents across the whole corpus work in rounds: each batch sends its distinct keys (combined on the map side, so
that a hot key costs one entry a batch, however often it occurs) to hash buckets, and each bucket answers per batch.
No group of documents ever has to meet in one task.
"""

from __future__ import annotations

import atexit
import ctypes
import shutil
import sys
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a batch gathers before it is closed; a longer document is a batch of its own.
BATCH_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Set here only where the session has none and runs on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="loom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Tables written while a `collecting` block is open go here.
_collected: list[str] | None = None


@contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Tables that are written inside the block are listed in paths, for `delete_tables`."""
    global _collected
    before, _collected = _collected, paths
    try:
        yield
    finally:
        _collected = before


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove written tables that nothing reads any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that outlive an executor."""
    path = f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if _collected is not None:
        _collected.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def pack(_level: int = 1, **arrays: np.ndarray | bytes) -> bytes:
    """Arrays as one compressed value."""
    head, body = [], []
    for k, v in arrays.items():
        kind = "raw" if isinstance(v, bytes) else v.dtype.str
        raw = v if isinstance(v, bytes) else np.ascontiguousarray(v).tobytes()
        head.append(f"{k},{kind},{len(raw)}")
        body.append(raw)
    return zstandard.ZstdCompressor(level=_level).compress(";".join(head).encode() + b"\n" + b"".join(body))


def unpack(blob: bytes) -> dict[str, np.ndarray | bytes]:
    raw = zstandard.ZstdDecompressor().decompress(bytes(blob))
    cut = raw.index(b"\n")
    out, at = {}, cut + 1
    for part in raw[:cut].decode().split(";"):
        if part:
            k, kind, n = part.split(",")
            piece = raw[at : at + int(n)]
            out[k] = piece if kind == "raw" else np.frombuffer(piece, dtype=kind)
            at += int(n)
    return out


def _cut(parts: Iterator[pa.RecordBatch], limit: int, part: int | None = None) -> Iterator[tuple[int, dict]]:
    """(batch number, arrays) of rows (doc_id, text, others), in slices of about `limit` bytes."""
    from pyspark import TaskContext

    part, k = TaskContext.get().partitionId() if part is None else part, 0
    for rows in parts:
        text = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"")
        size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        group = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            mine, ids = rows.slice(a, b - a), rows.column("doc_id").slice(a, b - a)
            arrays = {
                "ids": pc.fill_null(ids, 0).to_numpy(zero_copy_only=False),
                "null": pc.is_null(ids).to_numpy(zero_copy_only=False),
                "ends": np.cumsum(size[a:b] - 64),
                "text": b"".join(text.slice(a, b - a).to_pylist()),
            }
            if rows.num_columns > 2:
                sink = pa.BufferOutputStream()
                others = mine.select([c for c in mine.schema.names if c not in ("doc_id", "text")])
                with pa.ipc.new_stream(sink, others.schema) as out:
                    out.write_batch(others)
                arrays["others"] = sink.getvalue().to_pybytes()
            yield (part << 20) + k, arrays
            k += 1


def _batches(parts: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for number, arrays in _cut(parts, limit):
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([pack(5, **arrays)], pa.binary())], ["batch", "blob"])


def slices(parts: Iterator[pa.RecordBatch], limit: int, part: int | None = None) -> Iterator[tuple[int, Batch]]:
    """Batches of rows as they come, for operators that read the documents themselves."""
    for number, arrays in _cut(parts, limit, part):
        yield number, Batch(arrays)


def batch_documents(spark: SparkSession, docs: DataFrame, limit: int = BATCH_BYTES, others: Sequence[str] = ()) -> DataFrame:
    """Written table (batch long, blob binary) of all rows of docs(doc_id, text); a null text is empty.

    A batch number and a place in the batch name a row, also where doc_id is null or repeated. A place is under
    2**16, since each document counts for 64 bytes at least. `others` names columns that travel with the rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`") for c in others])
    return write_table(spark, rows.mapInArrow(lambda it: _batches(it, limit), "batch long, blob binary"), "batches")


class Batch:
    """The documents of one blob: ids, null flags, and bounds in one byte array."""

    def __init__(self, blob: bytes | dict):
        x = blob if isinstance(blob, dict) else unpack(blob)
        self.ids: np.ndarray = x["ids"]
        self.null: np.ndarray = x["null"]
        self.ends: np.ndarray = x["ends"]
        self.starts = np.concatenate([np.zeros(1, np.int64), self.ends[:-1]])
        self.text: bytes = x["text"]
        self._others = x.get("others")
        self.n = len(self.ids)

    @property
    def bytes(self) -> np.ndarray:
        return np.frombuffer(self.text, np.uint8)

    def texts(self) -> Iterator[str]:
        for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            yield self.text[a:b].decode()

    def others(self) -> pd.DataFrame:
        """The columns that travel with the rows."""
        nullable = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype(), pa.bool_(): pd.BooleanDtype()}
        out = pa.ipc.open_stream(self._others).read_all().to_pandas(types_mapper=nullable.get)
        # texts as plain objects: a column of Arrow's may come in several chunks, which a struct of columns doesn't take
        return out.astype({c: object for c in out if isinstance(out[c].dtype, pd.StringDtype)})

    def id_column(self) -> pd.Series:
        return pd.Series(np.where(self.null, None, self.ids.astype(object)), dtype="object").astype("Int64")


def trim() -> None:
    """Give memory that Arrow and the allocator hold, but don't use, back to the system: idle workers stay small."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_P = 0x9E3779B97F4A7C15 | 1
_POW: dict[tuple[int, bool], np.ndarray] = {}


def _powers(n: int, p: int = _P, inverse: bool = False) -> np.ndarray:
    have = _POW.get((p, inverse))
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        have = np.full(size, pow(p, -1, 1 << 64) if inverse else p, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POW[p, inverse] = have
    return have[:n]


class RollingHash:
    """64-bit polynomial hashes of any substring of a byte array, by prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray, p: int = _P):
        self.p = p
        x = data.astype(np.uint64)
        x += np.uint64(1)
        x *= _powers(len(data), p)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(x, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Raw hashes of data[start:end]; lengths are not mixed in."""
        return (self.sums[end] - self.sums[start]) * _powers(len(self.sums), self.p, True)[start]

    def all(self, k: int) -> np.ndarray:
        """Raw hashes of all k-grams, in order."""
        n = len(self.sums) - 1 - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[k:] - self.sums[:n]) * _powers(n, self.p, True)


#: [\x20\x09-\x0D] as a table over bytes.
SPACE = np.zeros(256, np.bool_)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words_of(batch: Batch, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, first): all words of the batch, and the index of each document's first word (n + 1 values).

    A word is a run of bytes other than ASCII white space; no word crosses documents. Hashes have 64 bits.
    """
    data = batch.bytes
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    n = len(data)
    word = ~SPACE[data]
    at_start = np.zeros(n + 1, np.bool_)
    at_start[batch.starts] = True  # of empty documents too, which does no harm
    prev = np.zeros(n, np.bool_)
    prev[1:] = word[:-1]
    start = np.flatnonzero(word & (~prev | at_start[:n]))
    nxt = np.zeros(n, np.bool_)
    nxt[:-1] = word[1:]
    at_end = np.zeros(n + 1, np.bool_)
    at_end[batch.ends] = True
    end = np.flatnonzero(word & (~nxt | at_end[1:])) + 1
    roll = RollingHash(data)
    h = mix(roll.of(start, end) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    first = np.searchsorted(start, np.concatenate([batch.starts, [n]]))
    return start, end, h, first


def buckets_for(spark: SparkSession, batches: DataFrame) -> int:
    """Hash buckets for rounds over these batches: a bucket gets about what a few batches hold."""
    return int(min(1 << 16, max(2 * parallelism(spark), batches.count() // 4, 1)))


def group_min(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys sorted, place of each key among them, least and greatest value of each)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), values, values
    order = np.argsort(keys)
    s = keys[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    first = np.flatnonzero(new)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    v = values[order]
    return s[first], inverse, np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)


def deal(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): keys[order[bounds[b]:bounds[b + 1]]] are those of bucket b, in the order of keys."""
    bucket = (keys % np.uint64(n)).astype(np.uint16 if n <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def requests(batch: int, keys: np.ndarray, n: int, short: bool = False, **values: np.ndarray) -> pd.DataFrame:
    """One row a bucket that has keys: (bucket, batch, blob). With `short`, four bytes of a key beside its bucket."""
    sent = (keys // np.uint64(n)).astype(np.uint32) if short else keys
    order, bounds = deal(keys, n)
    rows = []
    for b in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
        part = order[bounds[b] : bounds[b + 1]]
        rows.append((b, batch, pack(key=sent[part], **{k: v[part] for k, v in values.items()})))
    return pd.DataFrame(rows, columns=["bucket", "batch", "blob"])


def answers(keys: np.ndarray, n: int, rows: pd.DataFrame, name: str, dtype) -> np.ndarray:
    """What the buckets answered for these keys, in their order. rows: (bucket, blob)."""
    order, bounds = deal(keys, n)
    out = np.zeros(len(keys), dtype)
    for b, blob in zip(rows["bucket"].tolist(), rows["blob"], strict=True):
        part = order[bounds[b] : bounds[b + 1]]
        got = unpack(blob)[name]
        if dtype == np.bool_:
            got = np.unpackbits(got)[: len(part)].astype(np.bool_)
        out[part] = got
    return out


REQUEST = "bucket int, batch long, blob binary"


def least_of(frame: pd.DataFrame) -> pd.DataFrame:
    """The answers of one bucket: for each key asked for, the least value over all batches."""
    parts = [unpack(b) for b in frame["blob"]]
    _, place, least, _ = group_min(np.concatenate([p["key"] for p in parts]), np.concatenate([p["value"] for p in parts]))
    got, at, rows = least[place], 0, []
    for p, batch in zip(parts, frame["batch"].tolist(), strict=True):
        n = len(p["key"])
        rows.append((int(frame["bucket"].iloc[0]), batch, pack(least=got[at : at + n])))
        at += n
    return pd.DataFrame(rows, columns=["bucket", "batch", "blob"])


def answer_min(asked: DataFrame) -> DataFrame:
    """(bucket, batch, blob) with `least`."""
    return asked.groupBy("bucket").applyInPandas(least_of, REQUEST)
