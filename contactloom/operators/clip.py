"""Read clipping: a chain of narrow projections over (read_no, seq, qual), with statistics from one aggregate.

Steps, in order: fixed trims, adapters, ligation junction, trailing Ns, low-quality ends, low-quality bases inside,
quality padding, length. No step shuffles; all are SQL functions, so the chain also runs on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.functions.sites import QUALITY_ZERO

ADAPTER = "AGATCGGAAGAGC"
SEED = 7
MIN_LENGTH = 18


@dataclass(frozen=True)
class ClipSettings:
    junction: str
    recognition: str
    min_quality: int = 10
    scheme: str = "phred33"
    trim_5: int = 0
    trim_3: int = 0
    min_length: int = MIN_LENGTH
    max_reads: int | None = None
    adapters: Sequence[str] = field(default_factory=lambda: (ADAPTER,))


def _adapter_at(seq: Column, adapter: str) -> Column:
    """Where the adapter begins (from 0), or null: at the first place of its seed, if the read goes on as part of it
    or with under two mismatches, Ns aside."""
    at = F.instr(seq, adapter[:SEED])
    window = F.substring(seq, at, F.lit(len(adapter)))
    pairs = F.zip_with(
        F.split(window, ""),
        F.slice(F.array(*[F.lit(c) for c in adapter]), F.lit(1), F.length(window)),
        lambda a, b: F.when((a != b) & (a != "N"), 1).otherwise(0),
    )
    wrong = F.aggregate(pairs, F.lit(0), lambda s, x: s + x)
    return F.when((at > 0) & (F.instr(F.lit(adapter), window) > 0), at - 1).when((at > 0) & (wrong < 2), at - 1)


def _settled(df: DataFrame) -> DataFrame:
    """df behind a generator. Each step uses the last one's columns several times; without a stop, a filter pushed
    down through all steps would unfold into a sum of all their combinations."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def clip_all(reads: DataFrame, s: ClipSettings) -> DataFrame:
    """All reads (also too short ones) with clipped seq and qual, and flags and positions of what was done.

    Adds raw_length, adapter (index or null), junction_at, recog_at, clipped_quality, too_short.
    """
    df = reads if s.max_reads is None else reads.filter(F.col("read_no") <= s.max_reads)
    size = F.greatest(F.length("seq") - s.trim_5 - s.trim_3, F.lit(0))
    df = df.select(
        *[c for c in df.columns if c not in ("seq", "qual")],
        F.substring("seq", F.lit(s.trim_5 + 1), size).alias("seq"),
        F.substring("qual", F.lit(s.trim_5 + 1), size).alias("qual"),
    )
    df = df.withColumn("adapters", F.expr("cast(array() as array<int>)"))
    for k, adapter in enumerate(s.adapters):
        df = df.withColumn("_at", _adapter_at(F.col("seq"), adapter))
        for c in ("seq", "qual"):
            df = df.withColumn(c, F.when(F.col("_at").isNotNull(), F.substring(c, F.lit(1), F.col("_at"))).otherwise(F.col(c)))
        df = df.withColumn("adapters", F.when(F.col("_at").isNotNull(), F.array_append("adapters", F.lit(k))).otherwise(F.col("adapters")))
        df = _settled(df)
    junction = F.instr("seq", s.junction)
    before = F.substring("seq", F.lit(1), junction - 1)
    recog = F.when(junction > 0, F.instr(before, s.recognition)).otherwise(F.instr("seq", s.recognition))
    df = df.select(
        "*",
        F.when(junction > 0, junction - 1).alias("junction_at"),
        F.when(recog > 0, recog - 1).alias("recog_at"),
    )
    df = _settled(df)
    at = F.col("junction_at")
    df = df.withColumn("seq", F.when(at.isNotNull(), F.concat(F.substring("seq", F.lit(1), at), F.lit(s.recognition))).otherwise(F.col("seq")))
    df = df.withColumn("qual", F.when(at.isNotNull(), F.substring("qual", F.lit(1), at + len(s.recognition))).otherwise(F.col("qual")))
    df = _settled(df)
    # trailing Ns, then low-quality ends; the quality has as many characters as were taken off
    df = df.withColumn("_bare", F.rtrim(F.col("seq"), F.lit("N")))
    df = df.withColumn("_n", F.length("seq") - F.length("_bare")).withColumn("seq", F.col("_bare"))
    df = df.withColumn("qual", F.substring("qual", F.lit(1), F.greatest(F.length("qual") - F.col("_n"), F.lit(0))))
    df = _settled(df)
    zero = QUALITY_ZERO[s.scheme]
    low = f"[\\x00-\\x{zero + s.min_quality - 1:02X}]"
    kept3 = F.length(F.regexp_replace("qual", low + "+$", ""))
    df = df.withColumn("_k3", kept3).withColumn("_lost3", F.length("qual") - F.col("_k3"))
    for c in ("seq", "qual"):
        df = df.withColumn(c, F.substring(c, F.lit(1), F.greatest(F.length(c) - F.col("_lost3"), F.lit(0))))
    df = _settled(df)
    df = df.withColumn("_lost5", F.length("qual") - F.length(F.regexp_replace("qual", "^" + low + "+", "")))
    for c in ("seq", "qual"):
        df = df.withColumn(c, F.substring(c, F.col("_lost5") + 1, F.length(c)))
    df = _settled(df)
    df = df.withColumn("clipped_quality", (F.col("_n") > 0) | (F.col("_lost3") > 0) | (F.col("_lost5") > 0))
    masked = F.array_join(
        F.zip_with(
            F.split("seq", ""),
            F.split("qual", ""),
            lambda b, q: F.when(b.isNull(), F.lit("")).when(q.isNotNull() & (F.ascii(q) - zero < s.min_quality) & (F.length(q) > 0), F.lit("N")).otherwise(b),
        ),
        "",
    )
    df = df.withColumn("seq", F.when(F.col("qual").rlike(low), masked).otherwise(F.col("seq")))
    if len(s.junction) < len(s.recognition):
        df = df.withColumn("qual", F.when(F.length("qual") > 0, F.rpad("qual", F.length("seq"), F.substring("qual", -1, 1))).otherwise(F.col("qual")))
    return _settled(df.drop("_at", "_bare", "_n", "_k3", "_lost3", "_lost5")).withColumn("too_short", F.length("seq") < s.min_length)


def clip(reads: DataFrame, s: ClipSettings) -> DataFrame:
    """The clipped reads that are long enough; read numbers are those of all reads."""
    done = clip_all(reads, s).filter(~F.col("too_short"))
    return done.select(*reads.columns)


def clip_stats(clipped: DataFrame) -> DataFrame:
    """Counts over the result of clip_all. mean_length divides the kept bases by all reads."""
    n = F.count("*")
    kept = F.sum(F.when(~F.col("too_short"), F.length("seq")).otherwise(0))
    return clipped.agg(
        n.alias("input_reads"),
        F.count("junction_at").alias("junction"),
        F.count_if("clipped_quality").alias("quality"),
        F.count_if(F.size("adapters") > 0).alias("adapter"),
        F.count_if("too_short").alias("short"),
        F.round(kept / n, 6).alias("mean_length"),
    )


def position_histogram(clipped: DataFrame, column: str) -> DataFrame:
    """(pos, n, percent) of reads by position of the junction or recognition site, gaps filled with zeros."""
    counts = clipped.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("pos")).agg(F.count("*").alias("n"))
    total = clipped.agg(F.count("*").alias("total"))
    span = counts.agg(F.max("pos").alias("m")).filter("m is not null").select(F.explode(F.sequence(F.lit(0), F.col("m"))).alias("pos"))
    filled = span.join(counts, "pos", "left").crossJoin(F.broadcast(total))  # one row
    n = F.coalesce("n", F.lit(0)).cast("long")
    return filled.select(F.col("pos").cast("long").alias("pos"), n.alias("n"), F.round(100.0 * n / F.col("total"), 6).alias("percent"))


def quality_scheme(reads: DataFrame) -> DataFrame:
    """One row: least and greatest ordinal, and the scheme that they tell."""
    chars = reads.select(F.explode(F.array_distinct(F.split("qual", ""))).alias("c")).filter("c <> ''")
    lo, hi = F.col("lo"), F.col("hi")
    scheme = (
        F.when(lo < 33, "integer")
        .when((hi < 75) & (lo < 59), "phred33")
        .when((hi > 74) & (lo < 64), "solexa")
        .when(hi > 74, "phred64")
        .otherwise("phred33")
    )
    return chars.agg(F.min(F.ascii("c")).alias("lo"), F.max(F.ascii("c")).alias("hi")).select("lo", "hi", scheme.alias("scheme"))
