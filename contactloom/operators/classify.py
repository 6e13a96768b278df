"""The contact filter: fragments and sizes of each pair, then the first rule that holds, then whole ambiguity groups.

Rules are an ordered list of (tag, condition), evaluated as one CASE expression in a single pass; tags replace files.
Input: chr_a, start_a, end_a, strand_a, the same for b, pair_id, and any other columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.plan import apart, broadcast_if_small
from contactloom.operators.assign import to_fragment, to_star

NEAR = 10_000


@dataclass(frozen=True)
class FilterSettings:
    min_size: int = 150
    max_size: float = 1500
    re2_tolerance: int = 1000
    use_re: bool = True
    #: Without restriction fragments: sizes by signed lengths, as some older results have them.
    signed_sizes: bool = False

    @property
    def too_close(self) -> int:
        return int((self.min_size + self.max_size) / 2) if self.use_re else 75


def _trim(side: str) -> tuple[Column, Column, Column]:
    """(start, end, distance) of a fragment cut at its star site instead."""
    plus, star = F.col(f"strand_{side}") == "+", F.col(f"star_{side}")
    start = F.when(plus, F.col(f"f_start_{side}")).otherwise(star)
    end = F.when(plus, star).otherwise(F.col(f"f_end_{side}"))
    delta = F.when(plus, star - F.col(f"start_{side}")).otherwise(F.col(f"start_{side}") - star)
    return start, end, delta


def measure(pairs: DataFrame, re1: DataFrame | None, s: FilterSettings, re2: DataFrame | None = None, stars: DataFrame | None = None) -> DataFrame:
    """pairs with fragments (idx_*, f_start_*, f_end_*), distances delta_*, size, spans p1..p4, and known;
    with stars also cut_*: whether the fragment ends at its star site."""
    df = pairs
    known = F.lit(True)
    for side in "ab":
        df = df.withColumn(f"p_lo_{side}", F.least(f"start_{side}", f"end_{side}")).withColumn(f"p_hi_{side}", F.greatest(f"start_{side}", f"end_{side}"))
    if s.use_re:
        if re1 is None:
            raise ValueError("fragments are needed")
        for side in "ab":
            df = to_fragment(df, re1, f"chr_{side}", f"end_{side}", (f"idx_{side}", f"f_start_{side}", f"f_end_{side}"))
            d = F.when(F.col(f"strand_{side}") == "+", F.col(f"f_end_{side}") - F.col(f"start_{side}")).otherwise(F.col(f"start_{side}") - F.col(f"f_start_{side}"))
            df = df.withColumn(f"delta_{side}", F.when(F.col(f"idx_{side}").isNotNull(), F.greatest(d, F.lit(0))))
            df = apart(df, f"delta_{side}")
            known = known & F.col(f"idx_{side}").isNotNull()
        df = df.withColumn("size", F.col("delta_a") + F.col("delta_b"))
        if stars is not None:
            for side in "ab":
                df = to_star(df, stars, f"chr_{side}", f"start_{side}", f"strand_{side}", f"star_{side}")
            df = apart(df, "star_a", "star_b")
            both = F.col("star_a").isNotNull() & F.col("star_b").isNotNull() & (F.col("size") > s.max_size)
            inside = {x: both & (F.col(f"f_start_{x}") < F.col(f"star_{x}")) & (F.col(f"star_{x}") < F.col(f"f_end_{x}")) for x in "ab"}
            cut = {x: _trim(x) for x in "ab"}
            # the longer side first; the other one only if that is not enough
            first_a = inside["a"] & (~inside["b"] | (F.col("delta_a") > F.col("delta_b")))
            first_b = inside["b"] & ~first_a
            then_b = first_a & inside["b"] & (cut["a"][2] + F.col("delta_b") > s.max_size)
            then_a = first_b & inside["a"] & (F.col("delta_a") + cut["b"][2] > s.max_size)
            df = df.withColumn("cut_a", F.coalesce(first_a | then_a, F.lit(False))).withColumn("cut_b", F.coalesce(first_b | then_b, F.lit(False)))
            df = apart(df, "cut_a", "cut_b")
            for x in "ab":
                a, b, d = cut[x]
                df = df.withColumn("_s", a).withColumn("_e", b).withColumn("_d", d)
                for name, new in ((f"f_start_{x}", "_s"), (f"f_end_{x}", "_e"), (f"delta_{x}", "_d")):
                    df = df.withColumn(name, F.when(F.col(f"cut_{x}"), F.col(new)).otherwise(F.col(name)))
                df = apart(df.drop("_s", "_e", "_d"), f"f_start_{x}", f"f_end_{x}", f"delta_{x}")
            df = df.withColumn("size", F.col("delta_a") + F.col("delta_b")).drop("star_a", "star_b")
    else:
        cis = F.col("chr_a") == F.col("chr_b")
        gap = F.when(cis, F.abs(F.col("end_a") - F.col("end_b"))).otherwise(0)
        length = lambda x: F.col(f"end_{x}") - F.col(f"start_{x}")
        size = length("a") + length("b") if s.signed_sizes else F.abs(length("a")) + F.abs(length("b"))
        for i, side in enumerate("ab"):
            df = df.withColumn(f"idx_{side}", F.lit(2 * i).cast("long")).withColumn(f"f_start_{side}", F.col(f"start_{side}")).withColumn(f"f_end_{side}", F.col(f"end_{side}"))
        df = df.withColumn("delta_a", gap).withColumn("delta_b", gap).withColumn("size", size + s.min_size)
        if re1 is not None:
            names = broadcast_if_small(re1.select(F.col("chr").alias("_n")).distinct())
            for side in "ab":
                df = df.join(names.withColumn(f"_has_{side}", F.lit(True)), F.col(f"chr_{side}") == F.col("_n"), "left").drop("_n")
                known = known & F.col(f"_has_{side}").isNotNull()
    if re2 is not None:
        for side in "ab":
            df = to_fragment(df, re2, f"chr_{side}", f"end_{side}", (f"re2_{side}", f"re2_start_{side}", f"re2_end_{side}"))
            known = known & F.col(f"re2_{side}").isNotNull()
    return df.withColumn("known", known)


def rules(s: FilterSettings, re2: bool = False) -> list[tuple[str, Column]]:
    """(tag, condition) by priority; what fits none is accepted."""
    c = F.col
    cis, same = c("chr_a") == c("chr_b"), c("idx_a") == c("idx_b")
    plus_a, plus_b = c("strand_a") == "+", c("strand_b") == "+"
    out: list[tuple[str, Column]] = [("unknown_contig", ~c("known"))]
    if re2:
        far = lambda x: F.abs(F.when(c(f"strand_{x}") == "+", c(f"start_{x}") - c(f"re2_start_{x}")).otherwise(c(f"re2_end_{x}") - c(f"start_{x}"))) > s.re2_tolerance
        out += [("internal_re2", cis & (c("re2_a") == c("re2_b")) & same), ("no_end_re2", far("a") | far("b"))]
    outward = F.when(c("start_a") < c("start_b"), plus_b & ~plus_a).otherwise(plus_a & ~plus_b)
    over = lambda x: F.lit(False) | ((c(f"p_lo_{x}") < c(f"f_start_{x}")) & (c(f"f_start_{x}") < c(f"p_hi_{x}"))) | ((c(f"p_lo_{x}") < c(f"f_end_{x}")) & (c(f"f_end_{x}") < c(f"p_hi_{x}")))
    span = F.when(plus_a & ~plus_b & (c("p_lo_a") < c("p_lo_b")), c("p_hi_b") - c("p_lo_a")).when(plus_b & ~plus_a & (c("p_lo_b") < c("p_lo_a")), c("p_hi_a") - c("p_lo_b"))
    out += [
        ("circular_re1", cis & same & outward),
        ("overhang_re1", cis & same & (over("a") | over("b"))),
        ("internal_re1", cis & same),
        ("adjacent_re1", cis & (F.abs(c("idx_a") - c("idx_b")) < 2)),
        ("no_insert", cis & (span < 1) & (span < s.too_close)),
        ("too_close", cis & (span < s.too_close)),
        ("too_small", c("size") < s.min_size),
        ("too_big", c("size") > s.max_size),
    ]
    return out


def classify(pairs: DataFrame, re1: DataFrame | None, s: FilterSettings = FilterSettings(), re2: DataFrame | None = None, stars: DataFrame | None = None) -> DataFrame:
    """Measured pairs with `tag` and `separation` (near, far or trans; null unless accepted)."""
    df = apart(measure(pairs, re1, s, re2, stars), "size", "known")
    tag = F.lit("accepted")
    for name, condition in reversed(rules(s, re2 is not None)):
        tag = F.when(F.coalesce(condition, F.lit(False)), F.lit(name)).otherwise(tag)
    df = apart(df.withColumn("tag", tag), "tag")
    near = F.least(F.abs(F.col("p_lo_a") - F.col("p_lo_b")), F.abs(F.col("p_hi_a") - F.col("p_hi_b"))) < NEAR
    kind = F.when(F.col("chr_a") != F.col("chr_b"), "trans").when(near, "near").otherwise("far")
    return df.withColumn("separation", F.when(F.col("tag") == "accepted", kind))


def drop_groups(tagged: DataFrame) -> DataFrame:
    """tagged with accepted rows of a pair_id that also has a rejected row turned to excluded_group.

    One window over pair_id, which the pairing stage has already partitioned by.
    """
    bad = F.max(F.col("tag") != "accepted").over(Window.partitionBy("pair_id"))
    return tagged.withColumn("tag", F.when((F.col("tag") == "accepted") & bad, "excluded_group").otherwise(F.col("tag")))


def filter_pairs(pairs: DataFrame, re1: DataFrame | None, s: FilterSettings = FilterSettings(), re2: DataFrame | None = None, stars: DataFrame | None = None) -> DataFrame:
    return drop_groups(classify(pairs, re1, s, re2, stars))


def filter_counts(filtered: DataFrame) -> DataFrame:
    """(tag, n, percent) of all outcomes."""
    counts = filtered.groupBy("tag").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over a row an outcome
    return counts.select("tag", "n", F.round(100.0 * F.col("n") / total, 6).alias("percent"))


def separations(classified: DataFrame) -> DataFrame:
    """(separation, n) of accepted pairs before groups are dropped."""
    return classified.filter("separation is not null").groupBy("separation").agg(F.count("*").alias("n"))


def size_bin(size: Column) -> Column:
    return F.floor(10 * F.log10(F.greatest(size, F.lit(1)))).cast("long")


def size_histogram(classified: DataFrame) -> DataFrame:
    """(series, bin, n): all measured pairs, and the accepted ones by cis and trans, in bins of ten per decade."""
    df = classified.filter("known").withColumn("bin", size_bin(F.col("size")))
    series = F.array(F.lit("all"), F.when(F.col("tag") == "accepted", F.when(F.col("chr_a") == F.col("chr_b"), "cis").otherwise("trans")))
    return df.select("bin", F.explode(series).alias("series")).filter("series is not null").groupBy("series", "bin").agg(F.count("*").alias("n"))


def junction_histogram(classified: DataFrame, width: int = 10, bins: int = 100) -> DataFrame:
    """(strand, bin, n) of distances from read starts to the next ligation junction."""
    ends = F.array(*[F.struct(F.col(f"strand_{x}").alias("strand"), F.floor(F.col(f"delta_{x}") / width).cast("long").alias("bin")) for x in "ab"])
    df = classified.filter("known").select(F.explode(ends).alias("x")).select("x.strand", "x.bin")
    return df.filter(F.col("bin") < bins).groupBy("strand", "bin").agg(F.count("*").alias("n"))


def size_density(histogram: DataFrame) -> DataFrame:
    """size_histogram with `edge` (log10 of the bin's least size) and `percent`: of the accepted pairs of its series, for `all` of
    all accepted ones; a series without pairs counts as one."""
    total = lambda k: F.sum(F.when(F.col("series") == k, F.col("n")).otherwise(0)).over(Window.partitionBy())
    share = lambda t: F.when(t == 0, F.lit(1.0)).otherwise(0.01 * t)
    df = histogram.withColumn("_cis", share(total("cis"))).withColumn("_trans", share(total("trans")))  # over a row a bin
    part = F.when(F.col("series") == "cis", F.col("_cis")).when(F.col("series") == "trans", F.col("_trans")).otherwise(F.col("_cis") + F.col("_trans"))
    return df.select("series", "bin", (F.col("bin") / 10.0).alias("edge"), "n", F.round(F.col("n") / part, 9).alias("percent"))


def junction_density(histogram: DataFrame, width: int = 10, bins: int = 100) -> DataFrame:
    """(strand, edge, per_base) of junction_histogram over all bins of both strands: the bin's upper edge, and pairs a base."""
    spark = histogram.sparkSession
    every = spark.range(bins).select(F.col("id").alias("bin"), F.explode(F.array(F.lit("+"), F.lit("-"))).alias("strand"))
    df = every.join(histogram, ["strand", "bin"], "left")
    return df.select("strand", ((F.col("bin") + 1) * width).alias("edge"), (F.coalesce("n", F.lit(0)) / width).alias("per_base"))
