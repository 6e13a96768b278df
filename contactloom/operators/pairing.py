"""Pairing of alignments: each read's alignments per end, scored pairs, and ambiguity groups as NCC rows.

One shuffle on read_no brings all ends of a read together; the rest is on arrays of structs. Generators stand between its
steps, as a filter on outcomes would else unfold them into each other and pair a read's ends many times.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.functions.plan import apart, broadcast_if_small
from contactloom.functions.sites import QUALITY_ZERO

ALIGNMENT = "struct<chr:string,start:bigint,end:bigint,strand:string,score:bigint,genome:int>"


@dataclass(frozen=True)
class PairSettings:
    scheme: str = "phred33"
    close_second: int = 9
    near_cis: int = 1000
    worst: int = -24
    tolerance: int = 5
    report_ambiguous: bool = True
    unique_map: bool = False
    hybrid: bool = False


def normalise(alignments: DataFrame, names: DataFrame | None = None, scheme: str = "phred33") -> DataFrame:
    """(read_no, end, genome, aln) of mapped alignments: start and end in read direction, a mismatch at the 5' end of
    the reference taken off again, chromosome names from `names` (contig, chr) where there are any."""
    zero = QUALITY_ZERO[scheme]
    reverse = F.col("flag").bitwiseAND(16) != 0
    df = alignments.filter((F.col("flag").bitwiseAND(4) == 0) & (F.col("contig") != "*"))
    if names is not None:
        df = df.join(broadcast_if_small(names.select(F.col("contig").alias("_k"), F.col("chr").alias("_v"))), F.col("contig") == F.col("_k"), "left")
        df = df.withColumn("_chr", F.coalesce("_v", "contig"))
    else:
        df = df.withColumn("_chr", F.col("contig"))
    tail, head = reverse & F.col("md").rlike("[GCAT]0$"), F.col("md").rlike("^0[GCAT]")
    head = head & ~tail
    base = F.when(tail, F.substring("seq", -1, 1)).otherwise(F.substring("seq", 1, 1))
    q = F.ascii(F.when(tail, F.substring("qual", -1, 1)).otherwise(F.substring("qual", 1, 1))) - zero
    real = base != "N"
    gain = F.when((tail | head) & real, 2 + F.floor(4 * F.least(q, F.lit(40)) / 40)).otherwise(0)
    score = F.when(gain > 0, F.least(F.col("as_score") + gain, F.lit(0))).otherwise(F.col("as_score"))
    start = F.col("pos") + F.when(head & real, 1).otherwise(0)
    end = F.col("pos") + F.length("seq") - F.when(tail & real, 1).otherwise(0)
    genome = F.col("genome") if "genome" in alignments.columns else F.lit(0)
    aln = F.struct(
        F.col("_chr").alias("chr"),
        F.when(reverse, end).otherwise(start).cast("long").alias("start"),
        F.when(reverse, start).otherwise(end).cast("long").alias("end"),
        F.when(reverse, "-").otherwise("+").alias("strand"),
        score.cast("long").alias("score"),
        genome.cast("int").alias("genome"),
    )
    return df.select("read_no", "end", aln.alias("aln"))


def by_read(alignments: DataFrame) -> DataFrame:
    """(read_no, a, b): arrays of the alignments of each end, by falling score; empty where an end is missing."""
    pick = lambda e: F.sort_array(F.collect_list(F.when(F.col("end") == e, F.col("aln"))), asc=False)
    return alignments.groupBy("read_no").agg(pick(1).alias("a"), pick(2).alias("b"))


def narrowed(alns: Column, s: PairSettings) -> Column:
    """Alignments near the best score, and one of two that lie close together."""
    best = F.array_max(F.transform(alns, lambda x: x["score"]))
    near = F.when(F.size(alns) > 1, F.filter(alns, lambda x: x["score"] > best - s.close_second)).otherwise(alns)

    def collapse(v: Column) -> Column:
        two = (F.size(v) >= 2 if s.hybrid else F.size(v) == 2) & (v[0]["chr"] == v[1]["chr"]) & (F.abs(v[0]["start"] - v[1]["start"]) < s.near_cis)
        one = F.when(v[0]["score"] >= v[1]["score"], v[0]).otherwise(v[1])
        return F.when(two, F.array(one)).otherwise(v)

    return F.transform(F.array(near), collapse)[0]


def pair_reads(alignments: DataFrame, s: PairSettings = PairSettings()) -> DataFrame:
    """(read_no, outcome, pairs) from normalised alignments: outcome is unmapped_end, unique, ambiguous or all_poor;
    for hybrid genomes genome_ambiguous or position_ambiguous. pairs is an array of (a, b)."""
    df = by_read(alignments)
    if not s.unique_map:
        if s.hybrid:
            perfect = lambda c: F.filter(c, lambda x: x["score"] == 0)
            one = (F.size(perfect(F.col("a"))) == 1) & (F.size(perfect(F.col("b"))) == 1)
            df = df.select("read_no", *[F.when(one, perfect(F.col(c))).otherwise(narrowed(F.col(c), s)).alias(c) for c in "ab"])
        else:
            df = df.select("read_no", *[narrowed(F.col(c), s).alias(c) for c in "ab"])
    df = apart(df, "a", "b")
    pairs = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.struct((x["score"] + y["score"]).alias("sum"), x.alias("a"), y.alias("b")))))
    df = apart(df.withColumn("pairs", F.sort_array(pairs, asc=False)), "pairs").withColumn("best", F.get("pairs", F.lit(0))["sum"])
    if not s.unique_map:
        df = apart(df.withColumn("pairs", F.filter("pairs", lambda p: p["sum"] >= F.col("best") - s.tolerance)), "pairs")
    genomes = F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["a"]["genome"], p["b"]["genome"]))))
    many = F.lit("ambiguous") if not s.hybrid else F.when(genomes == F.size("pairs"), "genome_ambiguous").otherwise("position_ambiguous")
    outcome = (
        F.when((F.size("a") == 0) | (F.size("b") == 0), "unmapped_end")
        .when((F.col("best") < s.worst) & F.lit(not s.unique_map), "all_poor")
        .when(F.size("pairs") == 1, "unique")
        .otherwise(many)
    )
    df = apart(df.withColumn("outcome", outcome), "outcome")
    return df.select("read_no", "outcome", F.when(F.col("outcome").isin("unmapped_end", "all_poor"), F.array()).otherwise(F.col("pairs")).alias("pairs"))


def canonical(pairs: DataFrame) -> DataFrame:
    """Contacts of pair_reads with ends in order (chromosome by text, then start), group sizes and markers.

    Columns are those of NCC: chr_a, start_a, end_a, strand_a, ..b, ambig_size (rows of the group), marker (the size
    on the group's first row, else 0), active, pair_id, swap_pair.
    """
    rows = pairs.select("read_no", F.size("pairs").cast("long").alias("_n"), F.posexplode("pairs").alias("k", "p"))
    a, b = F.col("p.a"), F.col("p.b")
    swap = (a["chr"] > b["chr"]) | ((a["chr"] == b["chr"]) & (a["start"] > b["start"]))
    pick = lambda first, f: F.when(swap, (b if first else a)[f]).otherwise((a if first else b)[f])
    cols = [pick(x == "a", f).alias(f"{f}_{x}") for x in "ab" for f in ("chr", "start", "end", "strand")]
    return rows.select(*cols, F.col("_n").alias("ambig_size"), "k", F.col("read_no").alias("pair_id"), swap.cast("int").alias("swap_pair")).select(
        *[f"{f}_{x}" for x in "ab" for f in ("chr", "start", "end", "strand")],
        "ambig_size",
        F.when(F.col("k") == 0, F.col("ambig_size")).otherwise(0).alias("marker"),
        F.lit(True).alias("active"),
        "pair_id",
        "swap_pair",
    )


def to_contacts(alignments: DataFrame, s: PairSettings = PairSettings()) -> DataFrame:
    """Contacts of all unique reads, and of ambiguous ones if they are wanted (always, for hybrid genomes)."""
    kinds = ["unique"] + (["ambiguous", "genome_ambiguous", "position_ambiguous"] if s.report_ambiguous or s.hybrid else [])
    return canonical(pair_reads(alignments, s).filter(F.col("outcome").isin(kinds)))


def pair_stats(paired: DataFrame) -> DataFrame:
    return paired.groupBy("outcome").agg(F.count("*").alias("n"))


def unpaired(alignments: DataFrame) -> DataFrame:
    """(end, n): reads that have alignments for one end only."""
    ends = alignments.select("read_no", "end").distinct()
    other = ends.select("read_no", (3 - F.col("end")).alias("end"))
    return ends.join(other, ["read_no", "end"], "left_anti").groupBy("end").agg(F.count("*").alias("n"))
