"""Best-fit packing: tokenized documents into as few sequences as possible, large items first.

Documents are tokenized in place and cut to pieces of at most `capacity` ids; only the pieces' numbers are kept, in a
written table. Packing needs no more than how many pieces of each length there are: one row a length. The plan is made
from these counts on the driver, at a cost that depends on the capacity, not on the data:

1. Lengths above a third of the capacity: at most two fit a sequence. From the longest down, each is matched with the
   longest one that still fits (matching the most constrained first, so as many pairs as possible are made).
2. The others, from the longest down, go to the sequence with the smallest gap that takes them, else to a new one.

A step handles all equal pieces and all equal gaps at once, so a plan is a list of entries "pieces of this length with
ranks lo..hi go to sequences base.., at this offset". The rank of a piece among those of its length is counted in
salted groups, as many as the length's count asks for, so a length that a third of all pieces share is dealt out too.

Edge cases: doc_id is cast to long (an id that is no number fails or is null, by Spark's ANSI setting); a null text is empty, and an empty text is a piece of one id (the end mark); repeated rows are packed as
often as they occur; with no rows there is no sequence; a null doc_id is an id like any other.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom.llm.common import trim, write_table
from contactloom.llm.units import UnitEncoder, chunks

CAPACITY, END_ID = 4096, 1
TOKENIZER = "word_bpe_49k.json"
#: Rows of one length that are ranked together at most, on average.
RANKED = 2_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Beside them, a number that is spread evenly over rows, equal ones too.
SPREAD = PIECES + ", spread int"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def tokenizer_at(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def word_encoder(path: str) -> UnitEncoder:
    """Encoder of whole texts by `tokenizers`. Its pre-tokenizer drops white space and never joins words across it."""
    tokenizer = tokenizer_at(path)

    def encode(units: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def cut(texts: pa.Array) -> pa.ListArray:
        # fewer distinct units: the tokenizer lowers letters itself, and always cuts between a letter and a stop
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens are told by case
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,])", r"\1 \2")
        return pc.ascii_split_whitespace(texts)

    return UnitEncoder(cut, encode)


@lru_cache(maxsize=2)
def lasting_encoder(path: str) -> UnitEncoder:
    return word_encoder(path)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, lasting: bool = True) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32, spread) of all rows of docs (doc_id, text).

    A lasting encoder keeps the words that it has met for a worker's next tasks; the other one frees them.
    """
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "spread": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = (lasting_encoder if lasting else word_encoder)(path)
        made = TaskContext.get().partitionId() * 7919
        for batch in batches:
            for rows in chunks(batch):
                out: list[tuple] = []
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encode(rows.column("text")), strict=True):
                    ids = np.append(ids, end_id).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        made += 1
                        out.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes()), made * 0x9E3779B1 % (1 << 32) >> 2))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)], list(kinds))
        if not lasting:
            del encode
            trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, SPREAD)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Entries (length, lo, hi, per, base, at) and so the whole packing, from the number of pieces of each length.

    The piece of this length with rank r, lo <= r < hi, goes to sequence base + (r - lo) // per, at offset
    at + (r - lo) % per * length.
    """
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    entries: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> groups (first sequence, how many)
    sizes: list[int] = []  # gaps there are, sorted
    made = 0

    def put(length: int, n: int, per: int, base: int, at: int) -> None:
        entries.append((length, used[length], used[length] + n, per, base, at))
        used[length] += n
        left[length] -= n

    def leave(gap: int, base: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((base, n))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    rising = large[::-1]
    for n in large:
        while left[n]:
            i = bisect.bisect_right(rising, capacity - n) - 1
            while i >= 0 and not left[rising[i]]:
                i -= 1
            mate = rising[i] if i >= 0 else None
            if mate is None or mate == n and left[n] == 1:
                if mate is not None and i > 0 and (j := next((x for x in reversed(rising[:i]) if left[x]), None)) is not None:
                    mate = j
                else:
                    put(n, k := left[n], 1, made, 0)
                    leave(capacity - n, made, k)
                    made += k
                    break
            if mate == n:
                k = left[n] // 2
                put(n, 2 * k, 2, made, 0)
            else:
                k = min(left[n], left[mate])
                put(n, k, 1, made, 0)
                put(mate, k, 1, made, n)
            leave(capacity - n - mate, made, k)
            made += k
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            i = bisect.bisect_left(sizes, n)
            if i == len(sizes):
                base, many, gap = made, -(-left[n] // (capacity // n)), capacity
                made += many
            else:
                gap = sizes[i]
                base, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[i]
            per = gap // n
            full = min(many, left[n] // per)
            rest = left[n] - full * per if full < many else 0
            if full:
                put(n, full * per, per, base, capacity - gap)
                leave(gap - per * n, base, full)
            if rest:
                put(n, rest, rest, base + full, capacity - gap)
                leave(gap - rest * n, base + full, 1)
            leave(gap, base + full + bool(rest), many - full - bool(rest))
    return pd.DataFrame(entries, columns=["length", "lo", "hi", "per", "base", "at"]).sort_values(["length", "lo"], ignore_index=True)


def ranked(table: DataFrame, counts: dict[int, int]) -> DataFrame:
    """table with `rank`: 0.. among the rows of each length, each number once."""
    hot = {n: min(1 << 28, -(-c // RANKED)) for n, c in counts.items() if c > RANKED}
    salts: Column = F.lit(1)
    if hot:
        salts = F.coalesce(F.create_map(*[F.lit(x) for n, s in hot.items() for x in (n, s)])[F.col("length").cast("int")], F.lit(1))
    spread = table.withColumn("salt", F.pmod(F.col("spread"), salts).cast("int"))
    w = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    local = spread.withColumn("rank", F.row_number().over(w).cast("long") - 1)
    if not hot:
        return local.drop("salt")
    sizes = spread.groupBy("length", "salt").agg(F.count("*").alias("n")).filter(F.col("length").isin(*hot))
    before = sizes.withColumn(
        "skip", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "salt", F.coalesce("skip", F.lit(0)).alias("skip"))
    # at most rows / RANKED + one row a length: far under a thousandth of the pieces
    return local.join(before, ["length", "salt"], "left").withColumn("rank", F.col("rank") + F.coalesce("skip", F.lit(0))).drop("salt", "skip")


def pack(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, lasting: bool = True) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    table = write_table(spark, pieces(docs, path, capacity, end_id, lasting), "pieces")
    counts = {int(r["length"]): r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    entries = plan(counts, capacity)
    arrays = {c: entries[c].to_numpy(np.int64) for c in entries.columns}

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # one key for a length and a rank; entries are sorted by it
        wide = np.int64(1) << np.int64(48)
        keys = arrays["length"] * wide + arrays["lo"]
        for f in frames:
            n, r = f["length"].to_numpy(np.int64), f["rank"].to_numpy(np.int64)
            i = np.searchsorted(keys, n * wide + r, side="right") - 1
            over = r - arrays["lo"][i]
            f["sequence_id"] = arrays["base"][i] + over // arrays["per"][i]
            f["offset"] = arrays["at"][i] + over % arrays["per"][i] * n
            f["doc_id"] = pd.array([None if d is None or d != d else int(d) for d in f["doc_id"]], dtype="Int64")
            yield f.drop(columns="rank")

    rows = ranked(table, counts).select(F.col("doc_id").cast("string").alias("doc_id"), "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInPandas(place, PIECES + ", sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: all documents packed into sequences of 4096 ids."""
    return pack(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path(TOKENIZER))
