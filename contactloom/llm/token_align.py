"""Cross-tokenizer alignment: the finest groups of tokens of two tokenizers that cover the same bytes, and token links.

A slice of an Arrow batch is joined to one byte string, each text with a space before it, and so are the tokens of both
tokenizers. The ends of A's and of B's tokens are counted at every byte once; the string is cut where both have an end.
Between two neighbouring ends of either kind lie just one A token and one B token, so these stretches are the links (pairs
of tokens whose bytes overlap), one each. Prefix sums of ends, cuts and links, read at the ends of the texts, give what
each text has.

Corpus-wide link counts: a slice sends each distinct id pair once with its count, Spark sums them, and the slice gets
back one row for each pair that it has sent. Rows grow with the input, and a pair that all texts hold costs one row a
slice. Pair keys are a * size of B + b, so there are no more than the product of the vocabularies.

Texts are cut at spaces, and each distinct unit is encoded once: A's pre-tokenizer always begins a token at a space, but for
one inside a run of white space, and no entry of B runs on into a space (checked when the model is loaded). Other texts
(runs of white space around a space, leading or trailing spaces, U+2581) are encoded whole.

Edge cases: null and empty texts, and texts that one of the tokenizers doesn't give back byte for byte, have no tokens:
zeros, and an empty digest. Special tokens' strings are plain text. Repeated rows are counted as often as they occur; a
null doc_id stays null; an empty table gives an empty one; other columns are not read. `align` keeps doc_id's type, the
query casts it to long.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import pack, trim, unpack, write_table
from contactloom.llm.units import UnitEncoder, chunks

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of text in a slice, and units that each of the two encoders keeps: a worker holds both.
SLICE, STORE = 2 << 20, 200_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Encoder of texts, and the bytes of each id."""

    def __init__(self, entries: Sequence[bytes], quick: UnitEncoder, whole: Callable[[list[str]], list[Sequence[int]]], plain: Callable[[str], bool]):
        self.lengths = np.array([len(e) for e in entries], np.int32)
        self.begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.lengths, dtype=np.int64)[:-1]])
        self.all = np.frombuffer(b"".join(entries), np.uint8)
        self.size = len(entries)
        self._quick, self._whole, self._plain = quick, whole, plain

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        plain = [self._plain(t) for t in texts]
        quick = self._quick([t for t, p in zip(texts, plain, strict=True) if p])
        slow = iter(self._whole([t for t, p in zip(texts, plain, strict=True) if not p]))
        parts = [np.asarray(next(quick if p else slow), np.int32) for p in plain]
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.fromiter(map(len, parts), np.int64, len(parts))

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after another."""
        size = self.lengths[ids].astype(np.int64)
        stop = np.cumsum(size)
        place = np.arange(int(stop[-1]) if len(stop) else 0, dtype=np.int64)
        place += np.repeat(self.begins[ids] - (stop - size), size)
        return self.all[place]


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as itself, others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """A byte-level vocabulary; texts are encoded with a space before them."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    letters = _byte_letters()
    entries = [bytes(letters[c] for c in t.id_to_token(i)) for i in range(t.get_vocab_size())]

    def whole(texts: list[str]) -> list[Sequence[int]]:
        return [e.ids for e in t.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]

    loose = re.compile(r"\s \s|\s \Z")  # a space that begins no token
    return Vocabulary(entries, UnitEncoder(lambda x: pc.split_pattern(x, " "), whole, STORE), whole, lambda x: not loose.search(" " + x))


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    """A sentencepiece vocabulary that adds a space itself."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(SPACE in x.lstrip(SPACE) for x in names):
        raise ValueError("an entry runs on into a space")
    entries = [bytes([int(x[3:5], 16)]) if sp.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(names)]

    def whole(texts: list[str]) -> list[Sequence[int]]:
        return sp.encode(texts, num_threads=1)

    odd = re.compile(f"^ |  | \\Z|{SPACE}")
    return Vocabulary(entries, UnitEncoder(lambda x: pc.split_pattern(x, " "), whole, STORE), whole, lambda x: bool(x) and not odd.search(x))


def _at(sums: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What each text has, from prefix sums over the whole string."""
    return np.diff(sums[ends], prepend=0)


class Alignment:
    """Of the texts of one slice. n_a, n_b, n_groups, n_links: by text; the others by token, byte or link."""

    def __init__(self, texts: list[str], a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        raw = [(" " + t).encode() if t else b"" for t in texts]
        (self.a_ids, self.n_a), (self.b_ids, self.n_b) = a.encode([t if r else "" for t, r in zip(texts, raw, strict=True)]), b.encode(texts)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        self._drop(size == 0)
        sums = lambda v, ids, n: _at(np.concatenate([np.zeros(1, np.int64), np.cumsum(v.lengths[ids], dtype=np.int64)]), np.cumsum(n))
        self._drop((sums(a, self.a_ids, self.n_a) != size) | (sums(b, self.b_ids, self.n_b) != size))
        size = np.where(self.n_a > 0, size, 0)
        data = np.frombuffer(b"".join(r for r, n in zip(raw, size.tolist(), strict=True) if n), np.uint8)
        wrong = (a.bytes_of(self.a_ids) != data) | (b.bytes_of(self.b_ids) != data)
        if wrong.any():
            bad = np.bincount(np.searchsorted(np.cumsum(size), np.flatnonzero(wrong), side="right"), minlength=len(raw)) > 0
            self._drop(bad)
            size[bad] = 0
        self.ends = np.cumsum(size)
        total = int(size.sum())
        self.a_ends, self.b_ends = np.cumsum(a.lengths[self.a_ids], dtype=np.int64), np.cumsum(b.lengths[self.b_ids], dtype=np.int64)
        a_at, b_at = (np.bincount(e, minlength=total + 1).astype(np.int32) for e in (self.a_ends, self.b_ends))
        self.cut = a_at & b_at
        self.cuts = np.cumsum(self.cut, dtype=np.int32)
        either = a_at | b_at
        self.n_groups, self.n_links = _at(self.cuts, self.ends), _at(np.cumsum(either), self.ends)
        # the A and the B token of the stretch that ends here: as many have ended before
        stop = np.flatnonzero(either)
        self.link_a, self.link_b = (np.cumsum(x, dtype=np.int32)[stop] - x[stop] for x in (a_at, b_at))

    def _drop(self, bad: np.ndarray) -> None:
        """Texts without tokens."""
        if bad.any():
            self.a_ids, self.b_ids = self.a_ids[np.repeat(~bad, self.n_a)], self.b_ids[np.repeat(~bad, self.n_b)]
            self.n_a, self.n_b = np.where(bad, 0, self.n_a), np.where(bad, 0, self.n_b)

    def link_ids(self) -> np.ndarray:
        """a id * size of B + b id of each link."""
        return self.a_ids[self.link_a].astype(np.int64) * self.b.size + self.b_ids[self.link_b]

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(byte where each group ends, tokens of A, and of B, that end by then), counted from the slice's begin."""
        stop = np.flatnonzero(self.cut)
        return stop, np.searchsorted(self.a_ends, stop, side="right"), np.searchsorted(self.b_ends, stop, side="right")

    def written(self) -> Iterator[str]:
        """`a1,a2|b1;a3|b2,b3` of each text: the ids of each group."""
        n_a, n_b, n_g = len(self.a_ids), len(self.b_ids), int(self.cuts[-1]) if len(self.cuts) else 0
        of_a = self.cuts[self.a_ends - self.a.lengths[self.a_ids]]
        of_b = self.cuts[self.b_ends - self.b.lengths[self.b_ids]]
        before = lambda g: np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(g, minlength=n_g))])
        out = np.empty(n_a + n_b, object)
        out[np.arange(n_a) + before(of_b)[of_a]] = _marked(self.a.size, ",", "|")[self.a_ids + self.a.size * self.cut[self.a_ends]]
        out[np.arange(n_b) + before(of_a)[of_b + 1]] = _marked(self.b.size, ",", ";")[self.b_ids + self.b.size * self.cut[self.b_ends]]
        for x, y in pairwise([0, *np.cumsum(self.n_a + self.n_b).tolist()]):
            yield "".join(out[x:y].tolist())[:-1]


@lru_cache(maxsize=4)
def _marked(n: int, inner: str, last: str) -> np.ndarray:
    return np.array([f"{i}{inner}" for i in range(n)] + [f"{i}{last}" for i in range(n)], object)


def _rows(docs: DataFrame, cast: bool = False) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id") if cast else F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _slices(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[tuple[pa.RecordBatch, Alignment]]:
    a, b = byte_level(a_path), pieces(b_path)
    for batch in batches:
        for rows in chunks(batch, limit=SLICE):
            yield rows, Alignment(rows.column("text").to_pylist(), a, b)
    trim()


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, pa.int32()))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, bytes, a_ends, b_ends) of all rows of docs (doc_id, text): ids, and for each group the byte
    where it ends (of a space and the text) and how many tokens of A and of B end by then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _slices(batches, a_path, b_path):
            stop, by_a, by_b = x.groups()
            n, a_done, b_done, done = np.cumsum(x.n_groups), np.cumsum(x.n_a), np.cumsum(x.n_b), x.ends
            less = lambda values, totals: values - np.repeat(np.concatenate([[0], totals[:-1]]), x.n_groups)
            lists = [_lists(x.a_ids, a_done), _lists(x.b_ids, b_done), _lists(less(stop, done), n), _lists(less(by_a, a_done), n), _lists(less(by_b, b_done), n)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *lists], ["doc_id", "a_ids", "b_ids", "bytes", "a_ends", "b_ends"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _rows(docs).mapInArrow(run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, bytes array<int>, a_ends array<int>, b_ends array<int>")


def _measured(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Written table, one row a slice: (slice, pair array, n array, blob): its distinct id pairs with their numbers of links,
    and what its texts have, their links as places in `pair`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        for k, (rows, x) in enumerate(_slices(batches, a_path, b_path)):
            pair, place, n = np.unique(x.link_ids(), return_inverse=True, return_counts=True)
            ids = rows.column("doc_id")
            digest = b"".join(hashlib.sha256(t.encode()).digest() if t else bytes(32) for t in x.written())
            blob = pack(
                3,
                ids=pc.fill_null(ids, 0).to_numpy(zero_copy_only=False),
                null=pc.is_null(ids).to_numpy(zero_copy_only=False),
                n_a=x.n_a.astype(np.int32),
                n_b=x.n_b.astype(np.int32),
                n_groups=x.n_groups.astype(np.int32),
                n_links=x.n_links.astype(np.int32),
                digest=digest,
                links=place.astype(np.uint16 if len(pair) <= 1 << 16 else np.uint32),
            )
            lists = [pa.array([pair], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array([first + k], pa.int64()), *lists, pa.array([blob], pa.binary())], ["slice", "pair", "n", "blob"])

    return write_table(spark, _rows(docs, cast=True).mapInArrow(run, "slice long, pair array<long>, n array<long>, blob binary"), "aligned")


def _counts(measured: DataFrame) -> DataFrame:
    """(pair, links): how often each id pair is linked, over all slices."""
    return measured.select(F.explode(F.arrays_zip("pair", "n")).alias("x")).groupBy(F.col("x.pair").alias("pair")).agg(F.sum("x.n").alias("links"))


def link_counts(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a_id, b_id, links) over all rows of docs."""
    size = pieces(b_path).size
    return _counts(_measured(spark, docs, a_path, b_path)).select((F.floor(F.col("pair") / size)).cast("int").alias("a_id"), (F.col("pair") % size).cast("int").alias("b_id"), "links")


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each text has, with its slice's links looked up among the answers."""
    for batch in batches:
        for blob, answers in zip(batch.column("blob"), batch.column("answers"), strict=True):
            x = unpack(blob.as_py())
            links, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if answers.is_valid and len(answers):
                got = answers.values
                order = np.argsort(got.field("pair").to_numpy())
                links, best = (got.field(c).to_numpy()[order] for c in ("links", "best"))
            ends = np.cumsum(x["n_links"], dtype=np.int64)
            total = lambda v: _at(np.concatenate([np.zeros(1, np.int64), np.cumsum(v[x["links"]], dtype=np.int64)]), ends)
            digest = [x["digest"][i : i + 32].hex() if n else "" for i, n in zip(range(0, len(x["digest"]), 32), x["n_a"].tolist(), strict=True)]
            columns = [*(x[c].astype(np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")), total(best), total(links)]
            ids = pa.array(x["ids"].astype(np.int64), pa.int64(), mask=x["null"].astype(np.bool_))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns), pa.array(digest, pa.string())], [c.split()[0] for c in SCORED.split(", ")])


def score(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Of each row: its numbers of tokens, groups and links, how many links are among the commonest of their B id in the
    corpus, the sum of its links' corpus counts, and the digest of its groups."""
    size = pieces(b_path).size
    measured = _measured(spark, docs, a_path, b_path)
    counts = write_table(spark, _counts(measured).withColumn("b_id", F.col("pair") % size), "links")
    most = counts.groupBy("b_id").agg(F.max("links").alias("most"))  # a row for each entry of B
    marked = counts.join(most, "b_id").select("pair", "links", (F.col("links") == F.col("most")).cast("long").alias("best"))
    asked = measured.select("slice", F.explode("pair").alias("pair"))
    answers = asked.join(marked, "pair").groupBy("slice").agg(F.collect_list(F.struct("pair", "links", "best")).alias("answers"))
    return measured.select("slice", "blob").join(answers, "slice", "left").select("blob", "answers").mapInArrow(_scored, SCORED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the alignment of every whole document between the two tokenizers, as counts and digests."""
    return score(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path(A_FILE), tokenizer_path(B_FILE))
