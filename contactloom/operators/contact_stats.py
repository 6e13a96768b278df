"""Statistics of final contacts and of runs; all are tidy tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.plan import broadcast_if_small

CLASSES = ("cis_near", "cis_far", "trans", "homolog_trans")


def group_classes(contacts: DataFrame, homologs: DataFrame | None = None, far: int = 10_000) -> DataFrame:
    """(pair_id, n_pairs, code): the class of each ambiguity group, homolog before trans before far before near."""
    df = contacts
    code = F.when(F.col("chr_a") != F.col("chr_b"), 2)
    if homologs is not None:
        # a name has one partner: the table has a row a chromosome
        h = broadcast_if_small(homologs.select(F.col("chr").alias("_h"), F.col("partner").alias("_p")))
        df = df.join(h, F.col("chr_a") == F.col("_h"), "left")
        code = F.when((F.col("chr_a") != F.col("chr_b")) & (F.col("chr_b") == F.col("_p")), 3).otherwise(code)
    end = lambda x: F.when(F.col(f"strand_{x}") == "+", F.col(f"f_end_{x}")).otherwise(F.col(f"f_start_{x}"))
    code = F.coalesce(code, F.when(F.abs(end("a") - end("b")) < far, 0).otherwise(1))
    return df.groupBy("pair_id").agg(F.count("*").alias("n_pairs"), F.max(code).alias("code"))


def contact_stats(contacts: DataFrame, homologs: DataFrame | None = None) -> DataFrame:
    """One row: contacts (groups), ambiguous ones, pairs, mean ambiguity, and groups by class."""
    g = group_classes(contacts, homologs)
    many = F.col("n_pairs") > 1
    return g.agg(
        F.count("*").alias("total_contacts"),
        F.count_if(many).alias("ambig_contacts"),
        F.coalesce(F.sum("n_pairs"), F.lit(0)).cast("long").alias("total_pairs"),
        F.round(F.coalesce(F.sum(F.when(many, F.col("n_pairs"))), F.lit(0)) / F.greatest(F.count_if(many), F.lit(1)), 6).alias("mean_ambiguity"),
        *[F.count_if(F.col("code") == i).alias(name) for i, name in enumerate(CLASSES)],
    )


def mapping_stats(alignments: DataFrame, unmapped_flag: int = 4) -> DataFrame:
    """One row: reads, and how many have one, several or no mapped alignments."""
    n = F.count_if(F.col("flag").bitwiseAND(unmapped_flag) == 0)
    reads = alignments.groupBy("read_no", "end").agg(n.alias("n"))
    return reads.agg(F.count("*").alias("n_reads"), F.count_if(F.expr("n = 1")).alias("uniq"), F.count_if(F.expr("n > 1")).alias("ambiguous"), F.count_if(F.expr("n = 0")).alias("unmapped"))


def quartile_edges(histogram: DataFrame, shares: tuple[float, ...] = (0.25, 0.75), keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """(keys, share, edge): the end of the first bin at which the running count reaches each share of all."""
    w = Window.partitionBy(*keys)
    df = histogram.withColumn("_cum", F.sum("n").over(w.orderBy("bin"))).withColumn("_all", F.sum("n").over(w))
    df = df.withColumn("share", F.explode(F.array(*[F.lit(s) for s in shares])))
    return df.filter(F.col("_cum") >= F.col("share") * F.col("_all")).groupBy(*keys, "share").agg((F.min("bin") + 1).alias("edge"))


def as_stats(row: DataFrame, section: str, sample: str = "") -> DataFrame:
    """Tidy (sample, section, ord, key, value) of a table with one row."""
    pairs = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("key"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(row.columns)])
    return row.select(F.lit(sample).alias("sample"), F.lit(section).alias("section"), F.explode(pairs).alias("x")).select("sample", "section", "x.*")


#: Outcomes of the filter that are summed as "other".
OTHER = ("adjacent_re1", "overhang_re1", "too_close", "no_insert", "too_small", "too_big", "no_end_re2", "internal_re2")


def sample_table(stats: DataFrame) -> DataFrame:
    """One row a sample from tidy stats (sample, section, key, value): mapping, filter and contact percentages."""
    v = lambda section, key: F.coalesce(F.sum(F.when((F.col("section") == section) & (F.col("key") == key), F.col("value"))), F.lit(0.0))
    percent = lambda a, b: F.round(F.when(b != 0, 100.0 * a / b), 6)
    reads = v("map", "n_reads")
    total, contacts = v("filter", "input_pairs"), v("final", "total_contacts")
    other = reduce(lambda a, b: a + b, [v("filter", k) for k in OTHER])
    ambiguous = v("pair", "ambiguous") + v("pair", "position_ambiguous") + v("pair", "genome_ambiguous")
    return stats.groupBy("sample").agg(
        reads.cast("long").alias("reads"),
        percent(v("map", "uniq") + v("map", "ambiguous"), reads).alias("pc_map"),
        percent(ambiguous, v("pair", "total")).alias("pc_ambiguous"),
        percent(v("filter", "accepted"), total).alias("pc_accepted"),
        percent(other, total).alias("pc_other"),
        percent(v("final", "cis_near"), contacts).alias("pc_near"),
        percent(v("final", "cis_far"), contacts).alias("pc_far"),
        percent(v("final", "trans"), contacts).alias("pc_trans"),
    )


def join_by_root(ncc_files: DataFrame, stat_files: DataFrame) -> DataFrame:
    """(root, ncc_path, json_path) of files that belong together; stats without contacts raise an error."""
    root = lambda c: F.regexp_replace(F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", ""), r"(_r_1_2)?(_stats)?$", "")
    a = ncc_files.select(root("path").alias("root"), F.col("path").alias("ncc_path"))
    b = stat_files.select(root("path").alias("root"), F.col("path").alias("json_path"))
    alone = [r["json_path"] for r in b.join(a, "root", "left_anti").limit(5).collect()]
    if alone:
        raise ValueError(f"statistics without contacts: {alone}")
    return a.join(b, "root", "left")
