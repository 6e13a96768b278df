"""Genome digestion in blocks: restriction fragments, star sites, and overlapping windows of a sequence.

Contigs come as blocks of some bases (sources.genome) that run on into the next block, so each block finds its own sites by
itself, also one that goes over its end. What a block has to know of those before it (the last site, how many fragments
there are, how far the last site reaches in) comes from sums over one row a block. No contig is one value, and no task
works through a contig's bases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.plan import written
from contactloom.functions.sites import recognition, site_regex
from contactloom.sources.genome import BLOCK, blocks_of


def overlaps_itself(site: str) -> bool:
    """Whether two occurrences can share bases."""
    s = recognition(site)
    fits = lambda a, b: all(x == y or "N" in (x, y) for x, y in zip(a, b, strict=True))
    return any(fits(s[k:], s[:-k]) for k in range(1, len(s)))


def find_sites(blocks: DataFrame, sites: Sequence[str]) -> DataFrame:
    """(contig, site, block, start, bases, cuts, after): where each site begins in the block's own bases.

    A site that can overlap itself has all its places; after[c] tells how many bases the last one taken reaches into the
    next block where c bases of this one belong to a site that began before.
    """
    patterns = [(re.compile(f"(?={site_regex(s)})".encode()), len(recognition(s)), overlaps_itself(s)) for s in sites]
    kind = blocks.schema["contig"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, bases = batch.column("start").to_pylist(), batch.column("bases").to_pylist()
            for k, (pattern, length, again) in enumerate(patterns):
                cuts, after = [], []
                for start, n, seq in zip(starts, bases, batch.column("seq"), strict=True):
                    found = [m.start() for m in pattern.finditer(seq.as_py()) if m.start() < n]
                    cuts.append([start + i for i in found])
                    after.append([max([c - length, *taken(found, length, c)][-1] + length - n, 0) for c in range(length)] if again else [0] * length)
                columns = [batch.column("contig"), pa.array([k] * batch.num_rows, pa.int32()), batch.column("block"), batch.column("start"), batch.column("bases"), pa.array(cuts, pa.list_(pa.int64())), pa.array(after, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["contig", "site", "block", "start", "bases", "cuts", "after"])

    return blocks.select("contig", "block", "start", "bases", "seq").mapInArrow(run, f"contig {kind}, site int, block long, start long, bases long, cuts array<long>, after array<int>")


def taken(places: Sequence[int], length: int, begin: int) -> list[int]:
    """Of places in order, the first from `begin` on and each next one that begins after the one before ends."""
    out: list[int] = []
    for p in places:
        if p >= begin:
            out.append(p)
            begin = p + length
    return out


def _without_overlaps(found: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """found (with _into: how many bases of the block belong to a site that began before) with only the places taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("site", "start", "_into", "cuts")), strict=True)
            cuts = pa.array([taken(places, sizes[k], start + into) for k, start, into, places in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([cuts if c == "cuts" else batch.column(c) for c in names], names)

    names = ["contig", "site", "block", "start", "bases", "cuts"]
    kind = found.schema["contig"].dataType.simpleString()
    return found.select(*names, "_into").mapInArrow(run, f"contig {kind}, site int, block long, start long, bases long, cuts array<long>")


def pieces(blocks: DataFrame, sites: Sequence[str]) -> DataFrame:
    """(contig, site, block, pieces array<struct<start, end>>, length, last): the stretches between sites, each with the block
    in which the site after it begins (the last one of a contig: with the contig's last block, where `last` is true)."""
    found = written("sites", find_sites(blocks, sites))
    sizes = [len(recognition(s)) for s in sites]
    length = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("site") + 1)
    by = Window.partitionBy("contig", "site")
    earlier = by.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    if any(map(overlaps_itself, sites)):
        # how many bases of a block belong to a site that began before: the blocks' tables, one after another
        carry = F.aggregate(F.collect_list("after").over(earlier), F.lit(0), lambda c, table: F.get(table, c))
        into = found.select("contig", "site", "block", carry.alias("_into"))
        found = found.join(into, ["contig", "site", "block"])
        found = written("cuts", _without_overlaps(found, sizes))
    at = F.when(F.size("cuts") > 0, F.element_at("cuts", -1))
    known = found.select("contig", "site", "block", (F.col("start") + F.col("bases")).alias("_end"), at.alias("_at"))
    known = known.select(
        "contig", "site", "block", F.last("_at", ignorenulls=True).over(earlier).alias("_prev"), F.max("_end").over(by).alias("length"), (F.col("block") == F.max("block").over(by)).alias("last")
    )
    df = found.select("contig", "site", "block", "cuts").join(known, ["contig", "site", "block"])
    ends = F.when(F.col("last"), F.concat("cuts", F.array("length"))).otherwise(F.col("cuts"))
    starts = F.concat(F.array(F.coalesce(F.col("_prev") + length, F.lit(0).cast("long"))), F.transform("cuts", lambda c: c + length))
    rows = F.transform(ends, lambda e, i: F.struct(F.get(starts, i).alias("start"), e.alias("end")))
    return df.select("contig", "site", "block", rows.alias("pieces"), "length", "last")


def fragments(contigs: DataFrame, site: str, name: str = "contig", seq: str = "seq", block: int = BLOCK) -> DataFrame:
    """fragments_in_blocks of contigs that are values."""
    got = fragments_in_blocks(blocks_of(contigs, block, len(recognition(site)) - 1, name, seq), site)
    return got.withColumnRenamed("contig", name)


def fragments_in_blocks(blocks: DataFrame, site: str) -> DataFrame:
    """(contig, frag_idx, frag_start, frag_end), 0-based inclusive, of blocks that overlap by the site's length less one.

    The sequence is cut at each recognition site; a piece of n bases starting at s covers s .. s + n + site - 1, empty
    pieces make no fragment, and the last fragment ends with the contig.
    """
    size = len(recognition(site))
    some = F.filter("pieces", lambda p: p["end"] > p["start"])
    df = written("pieces", pieces(blocks, [site]).select("contig", "block", "length", some.alias("pieces")))
    by = Window.partitionBy("contig")
    n = F.size("pieces")
    before = F.coalesce(F.sum("_n").over(by.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = df.select("contig", "block", n.alias("_n"))  # a row a block, without its pieces
    known = known.select("contig", "block", before.alias("_before"), F.sum("_n").over(by).alias("_all"))
    rows = df.join(known, ["contig", "block"]).select("contig", "length", "_before", "_all", F.posexplode("pieces").alias("_k", "_p"))
    idx = F.col("_before") + F.col("_k")
    return rows.select(
        "contig",
        idx.cast("long").alias("frag_idx"),
        F.col("_p.start").alias("frag_start"),
        F.when(idx == F.col("_all") - 1, F.col("length") - 1).otherwise(F.col("_p.end") + size - 1).alias("frag_end"),
    )


def star_sites(contigs: DataFrame, sites: Sequence[str], name: str = "contig", seq: str = "seq", block: int = BLOCK) -> DataFrame:
    """star_sites_in_blocks of contigs that are values."""
    longest = max(len(recognition(s)) for s in sites)
    return star_sites_in_blocks(blocks_of(contigs, block, longest - 1, name, seq), sites).withColumnRenamed("contig", name)


def star_sites_in_blocks(blocks: DataFrame, sites: Sequence[str]) -> DataFrame:
    """(contig, pos): starts of the pieces of each alternative site, but for each site's last one. One pass for all sites."""
    df = pieces(blocks, sites)
    ended = F.when(F.col("last"), F.slice("pieces", F.lit(1), F.size("pieces") - 1)).otherwise(F.col("pieces"))
    return df.select("contig", F.explode(ended).alias("p")).select("contig", F.col("p.start").alias("pos"))


def windows(contigs: DataFrame, size: int, offset: int, name: str = "contig", seq: str = "seq", min_length: int = 18, block: int = 1 << 16) -> DataFrame:
    """windows_in_blocks of contigs that are values."""
    return windows_in_blocks(blocks_of(contigs, block, size, name, seq), size, offset, min_length).withColumnRenamed("contig", name)


def windows_in_blocks(blocks: DataFrame, size: int, offset: int, min_length: int = 18) -> DataFrame:
    """(contig, start, end, lead, tail, window): pieces of `size` every `offset` bases without outer Ns, over min_length bases
    long; lead and tail tell how many Ns were taken off. The blocks overlap by `size`.

    A window is cut from its block's bytes by place, and only windows, no blocks, are exploded.
    """
    first = F.ceil(F.col("start") / offset) * offset
    stop = F.col("start") + F.col("bases") - 1
    spots = F.when(first <= stop, F.sequence(first, stop, F.lit(offset).cast("long"))).otherwise(F.expr("cast(array() as array<bigint>)"))
    cut = F.transform(spots, lambda s: F.struct(s.alias("start"), F.substring("seq", (s - F.col("start") + 1).cast("int"), F.lit(size)).cast("string").alias("w")))
    df = blocks.select("contig", F.explode(cut).alias("x")).select("contig", "x.start", F.col("x.w").alias("_w"))
    df = df.withColumn("_l", F.ltrim(F.col("_w"), F.lit("N"))).withColumn("window", F.rtrim(F.col("_l"), F.lit("N")))
    return df.select(
        "contig",
        "start",
        (F.col("start") + F.length("_w")).cast("long").alias("end"),
        (F.length("_w") - F.length("_l")).cast("long").alias("lead"),
        (F.length("_l") - F.length("window")).cast("long").alias("tail"),
        "window",
    ).filter(F.length("window") > min_length)
