"""Contact maps and summaries of them. Their definitions are this package's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def positions(contacts: DataFrame) -> DataFrame:
    at = lambda x: F.when(F.col(f"strand_{x}") == "+", F.col(f"f_end_{x}")).otherwise(F.col(f"f_start_{x}")).alias(f"pos_{x}")
    return contacts.select("*", at("a"), at("b"))


def contact_map(contacts: DataFrame, bin_size: int = 25_000) -> DataFrame:
    """(chr_a, chr_b, bin_a, bin_b, n) over contacts with positions."""
    bins = [F.floor(F.col(f"pos_{x}") / bin_size).cast("long").alias(f"bin_{x}") for x in "ab"]
    return contacts.select("chr_a", "chr_b", *bins).groupBy("chr_a", "chr_b", "bin_a", "bin_b").agg(F.count("*").alias("n"))


def chromosome_limits(contacts: DataFrame) -> DataFrame:
    """(chr, lo, hi): the span of positions seen on each chromosome."""
    ends = contacts.select(F.explode(F.array(*[F.struct(F.col(f"chr_{x}").alias("chr"), F.col(f"pos_{x}").alias("pos")) for x in "ab"])).alias("e"))
    return ends.groupBy("e.chr").agg(F.min("e.pos").alias("lo"), F.max("e.pos").alias("hi"))


def contact_probability(contacts: DataFrame, bin_size: int = 100_000) -> DataFrame:
    """(bin, n, probability): cis contacts by separation, over the number of pairs of bins so far apart."""
    cis = contacts.filter("chr_a = chr_b").withColumn("bin", F.floor(F.abs(F.col("pos_a") - F.col("pos_b")) / bin_size).cast("long"))
    n = cis.groupBy("bin").agg(F.count("*").alias("n"))
    size = chromosome_limits(contacts).select((F.floor((F.col("hi") - F.col("lo")) / bin_size) + 1).cast("long").alias("bins"))
    possible = size.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") - 1)).alias("bin"), "bins").groupBy("bin").agg(F.sum(F.col("bins") - F.col("bin")).alias("possible"))
    return n.join(possible, "bin").select("bin", "n", F.round(F.col("n") / F.col("possible"), 9).alias("probability"))


def trans_density(contacts: DataFrame) -> DataFrame:
    """(chr_a, chr_b, n, density): trans contacts over the product of the chromosomes' spans in megabases."""
    spans = chromosome_limits(contacts).withColumn("mb", (F.col("hi") - F.col("lo") + 1) / 1e6)
    n = contacts.filter("chr_a <> chr_b").groupBy("chr_a", "chr_b").agg(F.count("*").alias("n"))
    a, b = (spans.select(F.col("chr").alias(f"chr_{x}"), F.col("mb").alias(f"_{x}")) for x in "ab")
    return n.join(a, "chr_a").join(b, "chr_b").select("chr_a", "chr_b", "n", F.round(F.col("n") / (F.col("_a") * F.col("_b")), 9).alias("density"))


def ploidy_deviation(contacts: DataFrame) -> DataFrame:
    """(chr, deviation): how far a chromosome's trans contacts are from the share that its span lets expect, as log2."""
    trans = F.when(F.col("chr_a") != F.col("chr_b"), 1).otherwise(0)
    ends = contacts.select(F.explode(F.array(*[F.struct(F.col(f"chr_{x}").alias("chr"), F.col(f"pos_{x}").alias("pos"), trans.alias("trans")) for x in "ab"])).alias("e"))
    df = ends.groupBy("e.chr").agg((F.max("e.pos") - F.min("e.pos") + 1).alias("span"), F.sum("e.trans").alias("n"))
    total = lambda c: F.sum(c).over(Window.partitionBy())  # over a row a chromosome
    ratio = (F.col("n") / total("n")) / (F.col("span") / total("span"))
    return df.select("chr", F.round(F.when(F.col("n") > 0, F.log2(ratio)), 9).alias("deviation"))


def isolated_fraction(contacts: DataFrame, near: int = 2_000_000) -> DataFrame:
    """One row: cis and trans contacts, and how many have no other contact in their 3 x 3 bins of `near` bases."""
    bins = contacts.withColumn("bin_a", F.floor(F.col("pos_a") / near)).withColumn("bin_b", F.floor(F.col("pos_b") / near))
    counts = bins.groupBy("chr_a", "chr_b", "bin_a", "bin_b").agg(F.count("*").alias("n"))
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    spread = counts.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps))
    around = spread.groupBy("chr_a", "chr_b", (F.col("bin_a") + F.col("_i")).alias("bin_a"), (F.col("bin_b") + F.col("_j")).alias("bin_b")).agg(F.sum("n").alias("around"))
    df = counts.join(around, ["chr_a", "chr_b", "bin_a", "bin_b"])
    alone = F.sum(F.when(F.col("around") == 1, 1).otherwise(0))
    kind = F.when(F.col("chr_a") == F.col("chr_b"), "cis").otherwise("trans")
    return df.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n"), alone.alias("isolated"))


def mito_fraction(contacts: DataFrame, names: tuple[str, ...] = ("chrM", "chrMt", "MT")) -> DataFrame:
    """One row: share of contacts with a mitochondrial end."""
    hit = F.col("chr_a").isin(*names) | F.col("chr_b").isin(*names)
    return contacts.agg(F.count("*").alias("n"), F.count_if(hit).alias("mito"), F.round(F.count_if(hit) / F.greatest(F.count("*"), F.lit(1)), 9).alias("fraction"))
