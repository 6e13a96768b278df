"""N-gram Jaccard join: MinHash candidates, pruned by a Bayesian rule, verified exactly.

1. Each text gives its distinct word sequence a number and a MinHash signature of its word n-grams. Texts with the
   same words are one node, so copies cost nothing further on.
2. Bands of the signatures name buckets. Buckets with the same members are kept once. Inside a bucket the signatures
   of two nodes are compared some values at a time; after each step a pair goes when, with m of n values equal and a
   uniform prior, the posterior probability that its similarity reaches the threshold is below the tolerance.
3. What survives connects nodes to groups. Inside a group all pairs are verified exactly on their n-gram sets.

Neither step emits pairs: a bucket gives the edges of a spanning star of its survivors, a group gives each node's number
of verified links and, again, a star. Buckets and groups over `block` nodes are cut to pairs of blocks. So a group with
thousands of different near copies costs comparisons, spread over tasks, but no rows.

Edge cases: doc_id is cast to long (an id that is no number fails or is null, by Spark's ANSI setting); null texts are empty; texts without words have no n-grams and no links, and are one class; texts of fewer
than n words are one n-gram; copies share class, text_id and n_links; a null doc_id is a row like any other, and a
class whose rows all have null ids has a null class_id; other columns are ignored by `join`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import Batch, _powers, batch_documents, mix, trim, words_of, write_table
from contactloom.llm.components import connected_components


@dataclass(frozen=True)
class Settings:
    n: int = 5
    #: The least similarity of a link, as a fraction.
    over: int = 4
    under: int = 5
    bands: int = 30
    rows: int = 4
    step: int = 12
    tolerance: float = 1e-7
    block: int = 512

    @property
    def size(self) -> int:
        return self.bands * self.rows


SCHEMA = "doc_id long, row long, n_words long, h1 long, h2 long, sig binary, bands binary"
ODD1, ODD2 = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5


def _sequence(h: np.ndarray, first: np.ndarray, odd: int) -> np.ndarray:
    """Polynomial hash of each document's words, from their hashes."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(len(h), odd), out=sums[1:])
    a, b = first[:-1], first[1:]
    inverse = _powers(len(h) + 1, odd, True)
    return mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))


def ngrams(batch: Batch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first, words, h1, h2): n-gram hashes of all documents (those of document i are first[i]:first[i + 1],
    with repeats), their numbers of words, and two hashes of their words."""
    _, _, h, at = words_of(batch)
    words = at[1:] - at[:-1]
    h1, h2 = _sequence(h, at, ODD1), _sequence(h, at, ODD2)
    count = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    s = h.copy()
    for k in range(1, n):
        s = s[: len(s) - 1] if len(s) else s
        if len(s):
            s = s * np.uint64(ODD1) + h[k : k + len(s)]
    s = mix(s)
    out = np.zeros(int(first[-1]), np.uint64)
    full = np.flatnonzero(words >= n)
    size = count[full]
    stop = np.cumsum(size)
    if len(full):
        step = np.arange(int(stop[-1]), dtype=np.int64)
        out[step + np.repeat(first[full] - (stop - size), size)] = s[step + np.repeat(at[full] - (stop - size), size)]
    short = np.flatnonzero((words > 0) & (words < n))
    out[first[short]] = h1[short]
    return out, first, words, h1, h2


def _signatures(s: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """uint32 MinHash values, one row a document; documents without n-grams have zeros."""
    out = np.zeros((len(first) - 1, size), np.uint32)
    some = np.flatnonzero(first[1:] > first[:-1])
    if not len(some):
        return out
    starts = first[some]
    rng = np.random.Generator(np.random.PCG64(20240607))
    factors = rng.integers(1 << 62, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    high = (s >> np.uint64(32)).astype(np.uint32)
    low = s.astype(np.uint32)
    buf = np.empty(len(s), np.uint32)
    for k, f in enumerate(factors.tolist()):
        # multiply-add on halves: 32-bit arithmetic, twice as fast and as good for the least value
        np.multiply(high, np.uint32((f >> 32) | 1), out=buf)
        buf ^= low * np.uint32((f & 0xFFFFFFFF) | 1)
        buf *= np.uint32(0x9E3779B1)
        buf ^= buf >> np.uint32(15)
        out[some, k] = np.minimum.reduceat(buf, starts)
    return out


def signatures(batches: DataFrame, cfg: Settings) -> DataFrame:
    """One row a document: row number, hashes of its words, signature (a byte a value), and band numbers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for number, blob in zip(f["batch"].tolist(), f["blob"], strict=True):
                b = Batch(blob)
                s, first, words, h1, h2 = ngrams(b, cfg.n)
                sig = _signatures(s, first, cfg.size)
                bands = np.zeros((b.n, cfg.bands), np.uint64)
                for k in range(cfg.bands):
                    x = np.full(b.n, k, np.uint64)
                    for c in range(cfg.rows):
                        x = x * np.uint64(ODD2) + sig[:, k * cfg.rows + c].astype(np.uint64)
                    bands[:, k] = mix(x)
                small = (sig ^ (sig >> 16)).astype(np.uint8)
                yield pd.DataFrame(
                    {
                        "doc_id": b.id_column(),
                        "row": (number << 16) + np.arange(b.n, dtype=np.int64),
                        "n_words": words,
                        "h1": h1.view(np.int64),
                        "h2": h2.view(np.int64),
                        "sig": [x.tobytes() for x in small],
                        "bands": [x.astype(">u8").tobytes() for x in bands],
                    }
                )
        trim()

    return batches.mapInPandas(run, SCHEMA)


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The least m of n equal values for which P(similarity >= threshold | m) >= tolerance, with a uniform prior.

    The posterior is Beta(m + 1, n - m + 1); its upper tail is a binomial sum.
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def _star(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least id that each node is connected with by the pairs (a, b) of places in ids."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    label, a, b = np.arange(len(ids)), rank[a], rank[b]
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return ids[order][label][rank]
        label = new


def _pairs(piece: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a piece: of all rows inside a block, else those between two blocks."""
    i, j, side = int(piece["i"].iloc[0]), int(piece["j"].iloc[0]), piece["side"].to_numpy()
    if i == j:
        return np.triu_indices(len(side), 1)
    x, y = np.flatnonzero(side == i), np.flatnonzero(side == j)
    return np.repeat(x, len(y)), np.tile(y, len(x))


def _pieces(members: DataFrame, key: str, size: str, node: str, block: int) -> DataFrame:
    """members dealt to pieces (key, i, j): a group over `block` rows to pairs of blocks, `side` telling them apart."""
    n = F.ceil(F.col(size) / block).cast("int")
    mine = F.pmod(F.xxhash64(node), n).cast("int")
    spots = F.transform(
        F.sequence(F.lit(0), n - 1), lambda o: F.struct(F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j"))
    )
    cols = [c for c in members.columns if c not in (size,)]
    dealt = members.select(*cols, mine.alias("side"), F.explode(spots).alias("x"))
    return dealt.select(*cols, "side", F.col("x.i").alias("i"), F.col("x.j").alias("j"))


def _by_piece(rows: DataFrame, key: str, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """call on the rows of each piece, streamed from sorted partitions: memory holds a frame and one piece."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            k, i, j = (f[c].to_numpy() for c in (key, "i", "j"))
            cut = np.flatnonzero((k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            bounds = [0, *cut.tolist()]
            out = [call(f.iloc[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            rest = f.iloc[bounds[-1] :]
            if out:
                yield pd.concat(out, ignore_index=True)
        if rest is not None and len(rest):
            yield call(rest)
        trim()

    return rows.repartition(F.col(key), F.col("i"), F.col("j")).sortWithinPartitions(key, "i", "j").mapInPandas(run, schema)


def candidates(spark: SparkSession, nodes: DataFrame, cfg: Settings) -> DataFrame:
    """Edges (a, b) that connect all pairs of nodes (node, sig, bands) that survive the pruning."""
    band = F.posexplode(F.sequence(F.lit(0), F.lit(cfg.bands - 1)))
    rows = nodes.select("node", "bands", band.alias("k", "_")).select("node", F.xxhash64(F.substring("bands", F.col("k") * 8 + 1, F.lit(8)), "k").alias("bucket"))
    sums = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("m"))
    once = sums.filter("n > 1").groupBy("n", "x", "m").agg(F.min("bucket").alias("bucket")).select("bucket", F.col("n").alias("size"))
    members = rows.join(once, "bucket").join(nodes.select("node", "sig"), "node")
    steps = [min(cfg.size, s) for s in range(cfg.step, cfg.size + cfg.step, cfg.step)]
    chance = cfg.over / cfg.under + (1 - cfg.over / cfg.under) / 256  # bytes of values are equal by chance too
    least = [least_matches(s, chance, cfg.tolerance) for s in steps]

    def compare(piece: pd.DataFrame) -> pd.DataFrame:
        ids = piece["node"].to_numpy()
        sig = np.frombuffer(b"".join(piece["sig"]), np.uint8).reshape(len(ids), cfg.size)
        a, b = _pairs(piece)
        same, at = np.zeros(len(a), np.int64), 0
        for stop, need in zip(steps, least, strict=True):
            same = same + (sig[a, at:stop] == sig[b, at:stop]).sum(1)
            keep = same >= need
            a, b, same, at = a[keep], b[keep], same[keep], stop
        root = _star(ids, a, b)
        linked = root != ids
        return pd.DataFrame({"a": root[linked], "b": ids[linked]})

    return _by_piece(_pieces(members, "bucket", "size", "node", cfg.block), "bucket", compare, "a long, b long")


def _verify(piece: pd.DataFrame, cfg: Settings) -> pd.DataFrame:
    """(node, root, links) of a piece: exact sizes of all intersections, by products of incidence blocks."""
    ids = piece["node"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in piece["grams"]]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(ids)), size)
    _, gram, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = np.cumsum(count > 1) - 1
    keep = count[gram] > 1
    owner, column = owner[keep], common[gram[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    inter = np.zeros((len(ids), len(ids)), np.float32)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        x = np.zeros((len(ids), width), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        inter += x @ x.T
    a, b = _pairs(piece)
    # over / under <= inter / (size a + size b - inter), in whole numbers
    good = (cfg.over + cfg.under) * np.rint(inter[a, b]).astype(np.int64) >= cfg.over * (size[a] + size[b])
    a, b = a[good], b[good]
    links = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
    return pd.DataFrame({"node": ids, "root": _star(ids, a, b), "links": links})


def join(spark: SparkSession, docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(doc_id, class_id, text_id, n_links, n_words, row) for every row of docs (doc_id, text).

    class_id: the least doc_id of all documents connected with it by links; text_id: the least doc_id with the same
    words; n_links: how many other texts, with different words, are similar to it.
    """
    return _join(spark, batch_documents(spark, docs), cfg)


def _join(spark: SparkSession, batches: DataFrame, cfg: Settings) -> DataFrame:
    rows = write_table(spark, signatures(batches, cfg), "signatures")
    texts = rows.groupBy("h1", "h2").agg(F.min("row").alias("node"), F.min("doc_id").alias("text_id"), F.max("n_words").alias("n_words"))
    texts = write_table(spark, texts, "texts")
    nodes = rows.join(texts.filter("n_words > 0").select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "sig", "bands")
    groups = connected_components(spark, candidates(spark, nodes, cfg))
    sizes = groups.groupBy("comp").agg(F.count("*").alias("size"))
    wanted = groups.join(sizes, "comp").withColumn("batch", F.shiftright("node", 16))

    def sets(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = right[["node", "comp", "size"]].copy()
        if not len(left) or not len(right):
            out["grams"] = pd.Series([], dtype=object) if not len(out) else None
            return out.iloc[:0]
        s, first, *_ = ngrams(Batch(left["blob"].iloc[0]), cfg.n)
        out["grams"] = [np.unique(s[first[i] : first[i + 1]]).tobytes() for i in (right["node"].to_numpy() & 0xFFFF).tolist()]
        return out

    grams = batches.groupBy("batch").cogroup(wanted.groupBy("batch")).applyInPandas(sets, "node long, comp long, size long, grams binary")
    checked = _by_piece(_pieces(grams, "comp", "size", "node", cfg.block), "comp", lambda p: _verify(p, cfg), "node long, root long, links long")
    checked = write_table(spark, checked, "checked")
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = connected_components(spark, checked.filter("root <> node").select(F.col("root").alias("a"), F.col("node").alias("b")))
    named = texts.join(classes, "node", "left").join(links, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = write_table(spark, named, "named")
    ids = named.groupBy("comp").agg(F.min("text_id").alias("class_id"))
    told = named.join(ids, "comp").select("h1", "h2", "class_id", "text_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows.select("doc_id", "row", "n_words", "h1", "h2").join(told, ["h1", "h2"]).select("doc_id", "class_id", "text_id", "n_links", "n_words", "row")


def keep_first(spark: SparkSession, docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """docs without all but the first (least doc_id, then least place) row of every class, with docs' columns."""
    rows = write_table(spark, docs.withColumn("_loom_key", F.monotonically_increasing_id()), "joined")
    got = join(spark, rows.select(F.col("_loom_key").alias("doc_id"), "text"), cfg).select(F.col("doc_id").alias("_loom_key"), "class_id")
    named = got.join(rows.select("_loom_key", "doc_id"), "_loom_key")
    first = named.groupBy("class_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("_loom_key").alias("c"))).alias("x"))
    kept = first.select(F.col("x.c").alias("_loom_key"))
    return rows.join(kept, "_loom_key", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: class, text and number of links of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return join(spark, docs).select("doc_id", "class_id", "text_id", "n_links")
