"""LM scoring: a hierarchical Pitman-Yor model of words, its Chinese restaurants seated by Gibbs sampling.

Every context (the whole word before, or the start of a text) has a restaurant, whose customers are the words that
follow it. Its tables are customers of the one parent restaurant that all contexts share, whose base is uniform over
the known words and one unknown one.

A Gibbs step takes all customers of one word out of one restaurant and seats them anew, given all else. Up to `exact`
customers, the number of their tables is drawn from its conditional distribution itself (generalised Stirling numbers
times rising powers); beyond, customers come in one after another (later ones in growing blocks), and one of
`proposals` such seatings is taken by its importance weight. Steps are made for a quarter of a bucket's pairs at a
time; between quarters all sums are renewed.

All pairs (word, context) of a word meet in one bucket, those of the heaviest words are dealt to all buckets:

1. Texts send their distinct pairs with training counts. Buckets merge them, and exchange through buckets of contexts
   how many customers and words each context has. Then each bucket samples; the tables of a context in other buckets
   are taken to have multiplied as its own pairs' have. Seatings of every sample are written, and the sums of tables.
2. Texts send their pairs again, with the documents that have them. Buckets know each sample's seating, and by the
   exchange the tables of every context in all buckets, so that a sample's predictive probabilities sum to one. The mean
   over samples is a pair's probability, and its logarithms are added up by document.

Nothing else is kept; documents are read twice. Words are told apart by 64-bit hashes, contexts of one word by 40 bits.

Edge cases: doc_id is cast to long (an id that is no number fails or is null, by Spark's ANSI setting); a null text is empty (its only token is the end); a null doc_id counts as the empty text for the split,
and so is held out; with no training documents all counts are zero and scores are those of the uniform base; repeated
rows count each time; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import Batch, answers, deal, mix, pack, slices, trim, unpack, words_of, write_table

END = mix(np.array([0x454E44], np.uint64))[0]
START = mix(np.array([0x5354415254], np.uint64))[0]


@dataclass(frozen=True)
class Settings:
    discount: float = 0.8
    strength: float = 2.0
    parent_discount: float = 0.6
    parent_strength: float = 20.0
    #: Sweeps before the first sample, and samples, whose predictive probabilities are averaged.
    burn: int = 3
    samples: int = 3
    exact: int = 64
    proposals: int = 4
    seed: int = 11
    batch_bytes: int = 4 << 20
    #: Bytes of text for each bucket, and documents in the sample that tells which words are dealt out. Neither changes
    #: the model; a word that the sample misses only makes its bucket larger.
    bucket_bytes: int = 16 << 20
    routing_docs: int = 2000
    routing_bytes: int = 16 << 20


LEAST_BUCKETS = 8


class Tokens:
    """Pairs (word, context) of a batch, in order of buckets, words and contexts."""

    def __init__(self, batch: Batch, n: int, heavy: np.ndarray, with_docs: bool):
        _, _, h, first = words_of(batch, lower=True)
        size = first[1:] - first[:-1]
        docs = np.arange(batch.n)
        tok = np.empty(len(h) + batch.n, np.uint64)
        tok[np.arange(len(h)) + np.repeat(docs, size)] = h
        tok[first[1:] + docs] = END
        before = np.empty(len(tok), np.uint64)
        before[1:] = tok[:-1]
        before[first[:-1] + docs] = START
        self.size = size + 1
        names = ["" if z else str(i) for i, z in zip(batch.ids.tolist(), batch.null.tolist(), strict=True)]
        self.held_out = np.array([zlib.crc32(x.encode()) % 10 == 0 for x in names], np.bool_)
        contexts, before = np.unique(before >> np.uint64(24), return_inverse=True)
        words, place = np.unique(tok, return_inverse=True)
        code = place.astype(np.int64) * len(contexts) + before
        owner = np.repeat(docs, self.size)
        if with_docs:
            # one entry for each pair and document
            full, times = np.unique(code * batch.n + owner, return_counts=True)
            code, self.doc = full // batch.n, (full % batch.n).astype(np.uint32)
            self.times = times.astype(np.uint32)
            new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
            self.reps = np.diff(np.append(new, len(code))).astype(np.uint32)
            self.entry = new
            weight = times * ~self.held_out[self.doc]
            self.count = (np.add.reduceat(weight, new) if len(new) else weight).astype(np.uint32)
            code = code[new]
        else:
            code, at = np.unique(code, return_inverse=True)
            self.count = np.bincount(at, weights=(~self.held_out)[owner], minlength=len(code)).astype(np.uint32)
        word, self.context = words[code // max(len(contexts), 1)], contexts[code % max(len(contexts), 1)]
        self.word = word
        bucket = route(word, self.context, n, heavy)
        self.order = np.argsort(bucket, kind="stable")
        self.bounds = np.searchsorted(bucket[self.order], np.arange(n + 1))
        self.with_docs = with_docs

    def blobs(self) -> Iterator[tuple[int, bytes]]:
        for b in np.flatnonzero(self.bounds[1:] > self.bounds[:-1]).tolist():
            p = self.order[self.bounds[b] : self.bounds[b + 1]]
            words, pairs = runs(self.word[p])
            arrays = dict(word=words, pairs=pairs, **split40(self.context[p]), count=self.count[p])
            if self.with_docs:
                reps = self.reps[p].astype(np.int64)
                stop = np.cumsum(reps)
                e = np.arange(int(stop[-1])) + np.repeat(self.entry[p] - (stop - reps), reps)
                arrays |= dict(reps=self.reps[p], doc=self.doc[e], times=self.times[e])
            yield b, pack(**arrays)


def route(word: np.ndarray, context: np.ndarray, n: int, heavy: np.ndarray) -> np.ndarray:
    """Buckets of pairs: by word, those of heavy words by word and context."""
    bucket = word % np.uint64(n)
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, word), len(heavy) - 1)
        dealt = heavy[at] == word
        bucket[dealt] = mix(word[dealt] ^ (context[dealt] * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(n)
    return bucket.astype(np.int64)


def runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of the runs of equal values."""
    new = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[new], np.diff(np.append(new, len(x))).astype(np.uint32)


def split40(x: np.ndarray) -> dict[str, np.ndarray]:
    return {"low": x.astype(np.uint32), "high": (x >> np.uint64(32)).astype(np.uint8)}


def join40(part: dict) -> np.ndarray:
    return part["low"].astype(np.uint64) | (part["high"].astype(np.uint64) << np.uint64(32))


class Bucket:
    """All requests of a bucket, merged: distinct words, contexts, and pairs with training counts."""

    def __init__(self, blobs: list[bytes], keep: bool = False):
        parts = [unpack(b) for b in blobs]
        cat = lambda f: np.concatenate([f(p) for p in parts]) if parts else np.zeros(0, np.uint64)
        self.words, place = np.unique(cat(lambda p: p["word"]), return_inverse=True)
        word = np.repeat(place, cat(lambda p: p["pairs"]).astype(np.int64)).astype(np.uint64)
        key, at = np.unique((word << np.uint64(40)) | cat(join40), return_inverse=True)
        self.c = np.bincount(at, weights=cat(lambda p: p["count"]), minlength=len(key)).astype(np.int64)
        self.w = (key >> np.uint64(40)).astype(np.int64)
        self.contexts, self.u = np.unique(key & np.uint64((1 << 40) - 1), return_inverse=True)
        self.place = np.split(at.astype(np.int32), np.cumsum([len(p["count"]) for p in parts])[:-1]) if keep and parts else []
        self.parts = [{k: p[k] for k in ("reps", "doc", "times")} for p in parts] if keep else []
        self.customers = np.bincount(self.u, weights=self.c, minlength=len(self.contexts)).astype(np.int64)

    def requests(self, frm: int, n: int, **values: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """(to, frm, blob) for each bucket of contexts: its contexts here, with values."""
        order, bounds = deal(self.contexts, n)
        for b in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            p = order[bounds[b] : bounds[b + 1]]
            yield b, frm, pack(**split40(self.contexts[p]), **{k: v[p] for k, v in values.items()})


@lru_cache(maxsize=4)
def stirling(discount: float, top: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: [c, t] is of the seatings of c customers at t tables."""
    out = np.full((top + 1, top + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(1, top + 1):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            out[c, 1 : c + 1] = np.logaddexp(out[c - 1, t - 1], out[c - 1, t] + np.log(np.maximum(c - 1 - discount * t, 0.0)))
    return out


#: chance(i, t): the parent's probability of the words of rows i, when t tables of theirs stand there already.
Chance = Callable[[np.ndarray, np.ndarray], np.ndarray]


def draw_tables(c: np.ndarray, others: np.ndarray, chance: Chance, discount: float, strength: float, cfg: Settings, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables for c customers of a word in a restaurant with `others` tables of other words.

    P(t) is proportional to S(c, t) times, for k = 0 .. t - 1, (strength + discount * (others + k)) * chance(k).
    """
    out = np.minimum(c, 1)
    room = strength + discount * others
    small = np.flatnonzero((c > 1) & (c <= cfg.exact))
    small = small[np.argsort(c[small], kind="stable")]
    sizes, first = np.unique(c[small], return_index=True)
    table, bounds = stirling(discount, cfg.exact), [*first.tolist(), len(small)]
    for size, a, b in zip(sizes.tolist(), bounds, bounds[1:], strict=False):
        for lo in range(a, b, max(1, (1 << 21) // size)):
            i = small[lo : min(b, lo + max(1, (1 << 21) // size))]
            k = np.arange(size)[None, :]
            x = np.log((room[i, None] + discount * k) * chance(i[:, None], k))
            np.cumsum(x, axis=1, out=x)
            x += table[size, 1 : size + 1]
            x -= x.max(axis=1, keepdims=True)
            np.cumsum(np.exp(x, out=x), axis=1, out=x)
            out[i] = 1 + (x < rng.random(len(i))[:, None] * x[:, -1:]).sum(axis=1)
    large = np.flatnonzero(c > cfg.exact)
    if len(large):
        ways = [_seat(c[large], room[large], lambda i, t: chance(large[i], t), discount, rng) for _ in range(cfg.proposals)]
        tables, weight = np.stack([w[0] for w in ways]), np.stack([w[1] for w in ways])
        pick = (weight + rng.gumbel(size=weight.shape)).argmax(axis=0)
        out[large] = tables[pick, np.arange(len(large))]
    return np.minimum(out, c)


def _seat(c: np.ndarray, room: np.ndarray, chance: Chance, discount: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(tables, log importance weight) of customers that come in one after another.

    The k-th opens a table with weight (room + discount * tables) * chance, else joins with k - 1 - discount * tables. From the
    ninth on, they come in blocks of an eighth of those seated, with the probability of the block's middle.
    """
    tables, weight = np.ones(len(c)), np.zeros(len(c))
    active, seated = np.arange(len(c)), 1
    while len(active):
        block = 1 if seated < 8 else seated // 8
        left = c[active] - seated
        size = np.minimum(left, block)
        t = tables[active]
        new = (room[active] + discount * t) * chance(active, t)
        total = new + seated + (size - 1) / 2 - discount * t
        weight[active] += size * np.log(total)
        tables[active] += rng.random(len(active)) < new / total if block == 1 else rng.binomial(size, np.minimum(new / total, 1.0))
        active, seated = active[left > block], seated + block
    return tables.astype(np.int64), weight


class Sampler:
    """Gibbs sweeps over one bucket; `types` are the words of each context in all buckets."""

    def __init__(self, b: Bucket, n: int, heavy: np.ndarray, types: np.ndarray, cfg: Settings, number: int):
        self.cfg, self.n = cfg, n
        self.rng = np.random.Generator(np.random.PCG64([cfg.seed, number]))
        self.seated = np.flatnonzero(b.c)
        self.c, self.w, self.u = b.c[self.seated], b.w[self.seated], b.u[self.seated]
        self.n_words, self.n_contexts = len(b.words), len(b.contexts)
        #: How many buckets share a word's pairs.
        self.share = np.where(np.isin(b.words, heavy), float(n), 1.0)
        self.t = np.ones(len(self.c), np.int64)
        self.rest = types - np.bincount(self.u, minlength=self.n_contexts)
        self.parent = np.zeros(self.n_words, np.int64)
        self.renew()
        self.parent = np.minimum(np.rint(self.customers), 1).astype(np.int64)
        self.color = self.rng.integers(0, 4, len(self.c)).astype(np.int8)

    def renew(self) -> None:
        self.own = np.bincount(self.u, weights=self.t, minlength=self.n_contexts)
        grown = self.t.sum() / max(len(self.t), 1)
        self.tables = self.own + self.rest * grown
        self.mine = np.bincount(self.w, weights=self.t, minlength=self.n_words)
        self.customers = self.mine * self.share

    def sums(self) -> tuple[float, float, float]:
        """Known words, tables and parent's tables of all buckets, by this one's."""
        trained = self.customers > 0
        return max(1.0, (trained / self.share).sum() * self.n), self.mine.sum() * self.n, (self.parent / self.share).sum() * self.n

    def sweep(self) -> None:
        cfg = self.cfg
        for color in range(4):
            i = np.flatnonzero(self.color == color)
            types, tables, parent = self.sums()
            w, t = self.w[i], self.t[i]
            base = (cfg.parent_strength + cfg.parent_discount * parent) / (types + 1)
            others = np.maximum(self.customers[w] - t, 0.0)
            # at the parent, own tables are customers that come to the word's tables, the first of all opens one
            there = np.minimum(self.parent[w], others)

            def chance(j: np.ndarray, k: np.ndarray, others=others, there=there, base=base, tables=tables) -> np.ndarray:
                n = others[j] + k
                return (np.maximum(n - cfg.parent_discount * np.maximum(there[j], np.minimum(n, 1)), 0.0) + base) / (cfg.parent_strength + tables)

            self.t[i] = draw_tables(self.c[i], np.maximum(self.tables[self.u[i]] - t, 0.0), chance, cfg.discount, cfg.strength, cfg, self.rng)
            self.renew()
        types, _, parent = self.sums()
        self.parent = self.seat_parent(np.rint(self.customers).astype(np.int64), parent, types)

    def seat_parent(self, customers: np.ndarray, parent: float, types: float) -> np.ndarray:
        return draw_tables(customers, np.maximum(parent - self.parent, 0.0), lambda i, t: np.full(np.broadcast(i, t).shape, 1 / (types + 1)), self.cfg.parent_discount, self.cfg.parent_strength, self.cfg, self.rng)

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables of pairs, of words at the parent, and of contexts here: a row for each sample."""
        for _ in range(self.cfg.burn):
            self.sweep()
        out: list[tuple] = []
        for _ in range(self.cfg.samples):
            self.sweep()
            out.append((self.t.copy(), self.parent.copy(), self.own.astype(np.int64)))
        return tuple(np.stack([x[i] for x in out]) for i in range(3))


@dataclass(frozen=True)
class Totals:
    """Numbers of the whole corpus; tables and parent (tables of the parent) for each sample."""

    tokens: int
    types: int
    tables: np.ndarray
    parent: np.ndarray
    #: Heavy words that the training texts have: hashes, counts, and for each sample tables and parent's tables.
    heavy: np.ndarray
    heavy_count: np.ndarray
    heavy_tables: np.ndarray
    heavy_parent: np.ndarray


def predict(cfg: Settings, t: Totals, c: np.ndarray, tables: np.ndarray, customers: np.ndarray, rooms: np.ndarray, word_tables: np.ndarray, word_parent: np.ndarray) -> np.ndarray:
    """Mean predictive probabilities of pairs with c customers. Arrays by sample: tables of the pair, of its context (of
    `customers` in all), and the tables and parent's tables of its word."""
    out = np.zeros(len(c))
    for s in range(cfg.samples):
        base = (cfg.parent_strength + cfg.parent_discount * t.parent[s]) / (t.types + 1)
        parent = (word_tables[s] - cfg.parent_discount * word_parent[s] + base) / (cfg.parent_strength + t.tables[s])
        out += (c - cfg.discount * tables[s] + (cfg.strength + cfg.discount * rooms[s]) * parent) / (cfg.strength + customers)
    return out / cfg.samples


REQUEST = "bucket int, batch long, blob binary"
EXCHANGE = "to int, frm int, blob binary"
SEATS = "kind int, to int, frm int, blob binary, num array<double>"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def _ask(rows: DataFrame, n: int, heavy: np.ndarray, cfg: Settings, with_docs: bool) -> DataFrame:
    """Requests of all documents; with documents, one row a batch also names them (bucket batch % n, batch negative)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in slices(parts, cfg.batch_bytes):
            x = Tokens(batch, n, heavy, with_docs)
            out = [(b, number, blob) for b, blob in x.blobs()]
            if with_docs:
                out.append((number % n, -1 - number, pack(ids=batch.ids, null=batch.null, held=x.held_out, size=x.size.astype(np.uint32))))
            for a in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out[a : a + 64], strict=True), (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["bucket", "batch", "blob"])
        trim()

    return rows.mapInArrow(run, REQUEST)


def _replies(sent: DataFrame) -> DataFrame:
    """(bucket, frm, blob): for the contexts that a bucket sent, the sums over all buckets, in its order."""

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(x) for x in frame["blob"]]
        keys, place = np.unique(np.concatenate([join40(p) for p in parts]), return_inverse=True)
        names = [k for k in parts[0] if k not in ("low", "high")]
        sums = {k: np.bincount(place, weights=np.concatenate([p[k] for p in parts]), minlength=len(keys)).astype(np.uint64) for k in names}
        cuts = np.cumsum([len(p["low"]) for p in parts])[:-1]
        blobs = [pack(**{k: v[mine] for k, v in sums.items()}) for mine in np.split(place, cuts)]
        return pd.DataFrame({"bucket": frame["frm"], "frm": frame["to"], "blob": blobs})

    return sent.groupBy("to").applyInPandas(merged, "bucket int, frm int, blob binary")


def heavy_words(rows: DataFrame, n: int, cfg: Settings) -> np.ndarray:
    """Hashes of words that are over a quarter of a bucket's share, by a sample; at most 4 * n.

    The sample is the texts with the least hashes of their ids and sizes, up to routing_docs texts and routing_bytes bytes, so
    it is the same however the rows are dealt; the driver gets no text before it knows that all fit.
    """
    keyed = rows.select("doc_id", "text", F.xxhash64("doc_id", F.octet_length("text")).alias("_h"))
    least = keyed.select("_h", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).orderBy("_h", "size").limit(cfg.routing_docs).collect()
    fits = np.flatnonzero(np.cumsum([r["size"] for r in least]) <= cfg.routing_bytes)
    if not len(fits):
        return np.zeros(0, np.uint64)
    some = keyed.filter(F.col("_h") <= least[fits[-1]]["_h"]).orderBy("_h").limit(len(fits)).select("doc_id", "text").toArrow()
    texts = [batch for _, batch in slices(iter(some.to_batches()), 1 << 30, part=0)]
    tok = np.concatenate([np.concatenate([words_of(b, lower=True)[2], np.full(b.n, END)]) for b in texts]) if texts else np.zeros(0, np.uint64)
    words, count = np.unique(tok, return_counts=True)
    return words[count > max(8, len(tok) / (4 * n))]


def score(spark: SparkSession, docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Scores of every row of docs (doc_id, text), by a model of those not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(LEAST_BUCKETS, -(-size // cfg.bucket_bytes)))  # by the data alone: one result on any cluster
    heavy = heavy_words(rows, n, cfg)
    asked = _ask(rows, n, heavy, cfg, False)

    def first(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        b = Bucket(frame["blob"].tolist())
        types = np.bincount(b.u[b.c > 0], minlength=len(b.contexts)).astype(np.uint32)
        out = pd.DataFrame(list(b.requests(int(key[0]), n, types=types)), columns=["to", "frm", "blob"])
        trim()
        return out

    def sample(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        number, S = int(key[0]), cfg.samples
        b = Bucket(left["blob"].tolist())
        known = right.assign(bucket=right["frm"])
        sampler = Sampler(b, n, heavy, answers(b.contexts, n, known, "types", np.int64), cfg, number)
        t, parent, own = sampler.run()
        small = lambda x: x.astype(np.uint32)
        count = np.bincount(b.w, weights=b.c, minlength=len(b.words))
        dealt = np.isin(b.words, heavy)
        mine = np.stack([np.bincount(sampler.w, weights=x, minlength=len(b.words)) for x in t])
        num = [float(count.sum()), float((count[~dealt] > 0).sum()), *map(float, t.sum(axis=1)), *map(float, parent[:, ~dealt].sum(axis=1))]
        state = pack(**{f"t{s}": small(t[s]) for s in range(S)}, **{f"p{s}": small(parent[s]) for s in range(S)})
        out: list[tuple] = [(0, number, number, state, num)]
        sums = b.requests(number, n, customers=small(b.customers), **{f"t{s}": small(own[s]) for s in range(S)})
        out += [(1, *x, []) for x in sums]
        at = np.searchsorted(heavy, b.words[dealt])
        out += [(2, int(i), number, b"", [float(count[j]), *map(float, mine[:, j])]) for i, j in zip(at, np.flatnonzero(dealt), strict=True)]
        trim()
        return pd.DataFrame(out, columns=[c.split()[0] for c in SEATS.split(", ")])

    types = _replies(asked.groupBy("bucket").applyInPandas(first, EXCHANGE))
    seats = write_table(spark, asked.groupBy("bucket").cogroup(types.groupBy("bucket")).applyInPandas(sample, SEATS), "seats")
    t = _totals(seats, heavy, cfg)
    told = _replies(seats.filter("kind = 1").select("to", "frm", "blob"))
    told = told.unionByName(seats.filter("kind = 0").select(F.col("frm").alias("bucket"), F.lit(-1).alias("frm"), "blob"))

    def answer(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        meta = left["batch"] < 0
        out = [(-1 - x, 0, blob) for x, blob in zip(left["batch"][meta].tolist(), left["blob"][meta], strict=True)]
        left = left[~meta]
        if len(left):
            b = Bucket(left["blob"].tolist(), keep=True)
            state = unpack(right["blob"][right["frm"] < 0].iloc[0])
            logs = _logs(b, state, right[right["frm"] >= 0].assign(bucket=lambda x: x["frm"]), n, t, cfg)
            for batch, part, at in zip(left["batch"].tolist(), b.parts, b.place, strict=True):
                at, times = np.repeat(at, part["reps"].astype(np.int64)), part["times"]
                doc, where = np.unique(part["doc"], return_inverse=True)
                known, base, model = (np.bincount(where, weights=times * v[at], minlength=len(doc)) for v in logs)
                out.append((batch, 1, pack(doc=doc.astype(np.uint32), known=known.astype(np.uint32), base=base, score=model)))
        trim()
        return pd.DataFrame(out, columns=["batch", "kind", "blob"])

    def finish(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = unpack(frame["blob"][frame["kind"] == 0].iloc[0])
        m = len(x["ids"])
        sums = {k: np.zeros(m) for k in ("known", "base", "score")}
        for blob in frame["blob"][frame["kind"] == 1]:
            part = unpack(blob)
            for k, v in sums.items():
                v[part["doc"]] += part[k]
        tokens = x["size"].astype(np.int64)
        return pd.DataFrame(
            {
                "doc_id": pd.Series(np.where(x["null"], None, x["ids"].astype(object)), dtype="object").astype("Int64"),
                "held_out": x["held"],
                "n_tokens": tokens,
                "n_known": sums["known"].astype(np.int64),
                "train_tokens": np.full(m, t.tokens, np.int64),
                "base_score": sums["base"],
                "score": sums["score"],
                "perplexity": 10 ** np.minimum(-sums["score"] / tokens, 300.0),
            }
        )

    again = _ask(rows, n, heavy, cfg, True)
    sums = again.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInPandas(answer, "batch long, kind int, blob binary")
    return sums.groupBy("batch").applyInPandas(finish, SCORES)


def _totals(seats: DataFrame, heavy: np.ndarray, cfg: Settings) -> Totals:
    S = cfg.samples
    at = lambda i: F.coalesce(F.sum(F.get("num", F.lit(i))), F.lit(0.0))
    x = list(seats.filter("kind = 0").agg(*[at(i).alias(f"n{i}") for i in range(2 + 2 * S)]).first())
    rows = sorted(seats.filter("kind = 2").groupBy("to").agg(*[at(i).alias(f"n{i}") for i in range(1 + S)]).collect())  # heavy words: 4 a bucket
    table = np.array([list(r) for r in rows if r["n0"] > 0]).reshape(-1, 2 + S)
    types = int(x[1]) + len(table)
    tables, parent = np.array(x[2 : 2 + S]), np.array(x[2 + S :])
    heavy_tables = table[:, 2:].T
    rng = np.random.Generator(np.random.PCG64([cfg.seed, 1 << 31]))
    even = lambda i, t: np.full(np.broadcast(i, t).shape, 1 / (types + 1))
    own = [draw_tables(c.astype(np.int64), np.full(len(c), p), even, cfg.parent_discount, cfg.parent_strength, cfg, rng) for c, p in zip(heavy_tables, parent, strict=True)]
    own = np.stack(own).astype(float)
    return Totals(int(x[0]), types, tables, parent + own.sum(axis=1), heavy[table[:, 0].astype(np.int64)] if len(heavy) else heavy, table[:, 1], heavy_tables, own)


def _logs(b: Bucket, state: dict, replied: pd.DataFrame, n: int, t: Totals, cfg: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair: whether the word is known, its base logarithm, the model's."""
    S, m = cfg.samples, len(b.words)
    seated = np.flatnonzero(b.c)
    count = np.bincount(b.w, weights=b.c, minlength=m)
    pair = np.zeros((S, len(b.c)))
    word = np.zeros((S, m))
    parent = np.zeros((S, m))
    for s in range(S):
        pair[s, seated] = state[f"t{s}"]
        word[s] = np.bincount(b.w, weights=pair[s], minlength=m)
        parent[s] = state[f"p{s}"]
    if len(t.heavy):
        at = np.minimum(np.searchsorted(t.heavy, b.words), len(t.heavy) - 1)
        dealt = np.flatnonzero(t.heavy[at] == b.words)
        count[dealt] = t.heavy_count[at[dealt]]
        word[:, dealt], parent[:, dealt] = t.heavy_tables[:, at[dealt]], t.heavy_parent[:, at[dealt]]
    customers = answers(b.contexts, n, replied, "customers", np.float64)
    rooms = np.stack([answers(b.contexts, n, replied, f"t{s}", np.float64) for s in range(S)])
    p = np.empty(len(b.c))
    for lo in range(0, len(p), 1 << 17):
        i = slice(lo, lo + (1 << 17))
        u, w = b.u[i], b.w[i]
        p[i] = predict(cfg, t, b.c[i], pair[:, i], customers[u], rooms[:, u], word[:, w], parent[:, w])
    base = np.log10((count + 0.1) / (t.tokens + 0.1 * (t.types + 1)))
    return (count > 0)[b.w].astype(float), base[b.w], np.log10(p, out=p)


def held_out_perplexity(scores: DataFrame) -> DataFrame:
    """One row: the perplexity of all held-out tokens."""
    return scores.filter("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: scores of every document."""
    return score(spark, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
