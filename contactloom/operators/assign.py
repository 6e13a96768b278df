"""As-of joins: positions to restriction fragments, and to star sites.

Each fragment owns the stretch after its predecessor's end up to its own end, so "the first fragment that ends at or
after the position" is containment. Owned stretches are cut to bins, and the join is an equi-join on (chr, bin) with a
residual range check. Bins are about as long as a mean stretch, so a position meets two or three fragments, whatever the
enzyme; small tables are broadcast, so that reads are not shuffled, and in larger ones a chromosome has many keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.plan import broadcast_if_small



def mean_bin(ends: DataFrame, pos_col: str) -> int:
    """A power of two, at least the mean length of the stretches between ends (chr and a position)."""
    ends = ends.groupBy("chr").agg(F.max(pos_col).alias("last"), F.count("*").alias("n"))
    bases, n = ends.agg(F.sum(F.col("last") + 1), F.sum("n")).first()  # one row
    return 1 << max(6, (max(1, int(bases or 0)) // max(1, n or 0)).bit_length())


def owned(frags: DataFrame, bin_size: int) -> DataFrame:
    """frags (chr, frag_idx, frag_start, frag_end) with owned stretch lo..hi, one row for each bin that it meets."""
    w = Window.partitionBy("chr").orderBy("frag_end")
    df = frags.withColumn("lo", F.coalesce(F.lag("frag_end").over(w) + 1, F.lit(0))).withColumn("hi", F.col("frag_end"))
    return df.withColumn("bin", F.explode(F.sequence(F.floor(F.col("lo") / bin_size), F.floor(F.col("hi") / bin_size))))


def to_fragment(rows: DataFrame, frags: DataFrame, chr_col: str, pos_col: str, out: tuple[str, str, str], bin_size: int | None = None) -> DataFrame:
    """rows with the index, start and end (named by `out`) of the first fragment whose end is at or after the position.

    Positions beyond the last fragment get the last one; chromosomes without fragments get nulls.
    """
    bin_size = bin_size or mean_bin(frags, "frag_end")
    last = frags.groupBy(F.col("chr").alias("_c")).agg(F.max("frag_end").alias("_last"))
    df = rows.join(broadcast_if_small(last), F.col(chr_col) == F.col("_c"), "left")
    df = df.withColumn("_pos", F.greatest(F.least(F.col(pos_col), F.col("_last")), F.lit(0))).withColumn("_bin", F.floor(F.col("_pos") / bin_size))
    f = owned(frags, bin_size).select(
        F.col("chr").alias("_fc"), F.col("bin").alias("_fb"), "lo", "hi", F.col("frag_idx").alias(out[0]), F.col("frag_start").alias(out[1]), F.col("frag_end").alias(out[2])
    )
    match = (F.col(chr_col) == F.col("_fc")) & (F.col("_bin") == F.col("_fb")) & (F.col("_pos") >= F.col("lo")) & (F.col("_pos") <= F.col("hi"))
    return df.join(broadcast_if_small(f), match, "left").select(*rows.columns, *out)


def to_star(rows: DataFrame, stars: DataFrame, chr_col: str, pos_col: str, strand_col: str, out: str, bin_size: int | None = None) -> DataFrame:
    """rows with the nearest star site: at or after the position on the + strand, before it on the - strand; beyond the
    outermost site that one. Null on chromosomes without sites.

    Sites own stretches as fragments do: (previous, own] forwards and (own, next] backwards.
    """
    bin_size = bin_size or mean_bin(stars, "pos")
    w = Window.partitionBy("chr").orderBy("pos")
    s = stars.select("chr", "pos").distinct()
    s = s.withColumn("_k", F.row_number().over(w) - 1).withColumn("_before", F.lag("pos").over(w))
    # between two sites, (before, pos]: forwards it is pos, backwards it is before (the first site where there is none)
    gap = s.select(F.col("chr").alias("_c"), F.coalesce(F.col("_before") + 1, F.lit(0)).alias("lo"), F.col("pos").alias("hi"), F.col("pos").alias("_next"), F.coalesce("_before", "pos").alias("_prev"))
    ends = s.groupBy(F.col("chr").alias("_e")).agg(F.max("pos").alias("_last"))
    df = rows.join(broadcast_if_small(ends), F.col(chr_col) == F.col("_e"), "left").withColumn("_over", F.col(pos_col) > F.col("_last"))
    df = df.withColumn("_p", F.greatest(F.least(F.col(pos_col), F.col("_last")), F.lit(0))).withColumn("_bin", F.floor(F.col("_p") / bin_size))
    g = gap.withColumn("_gb", F.explode(F.sequence(F.floor(F.col("lo") / bin_size), F.floor(F.col("hi") / bin_size))))
    match = (F.col(chr_col) == F.col("_c")) & (F.col("_bin") == F.col("_gb")) & (F.col("_p") >= F.col("lo")) & (F.col("_p") <= F.col("hi"))
    got = df.join(broadcast_if_small(g), match, "left")
    star = F.when(F.col("_over"), F.col("_last")).when(F.col(strand_col) == "+", F.col("_next")).otherwise(F.col("_prev"))
    return got.select(*rows.columns, star.alias(out))
