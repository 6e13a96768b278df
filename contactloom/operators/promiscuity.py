"""Promiscuous fragment ends: ends with more partners than the ploidy allows, and the groups that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.functions.plan import written

RESOLVE, CLOSE_CIS = 1_000, 10_000


def end_classes(contacts: DataFrame, copies: int = 2, resolve: int = RESOLVE, close_cis: int = CLOSE_CIS) -> DataFrame:
    """(chr, pos, strand, n_ends, n_groups, remove, resolve) of every end with more than `copies` partners and groups.

    With one partner too many, each pair of partners decides: partners near each other, and in trans or far from this
    end, resolve it; any other pair removes it. With more partners it is removed. Partners are compared for ends with
    copies + 1 of them only, so no end's partners are ever collected in full.
    """
    side = lambda x, y: F.struct(
        F.col(f"chr_{x}").alias("chr"), F.col(f"f_start_{x}").alias("pos"), F.col(f"strand_{x}").alias("strand"),
        F.struct(F.col(f"chr_{y}").alias("chr"), F.col(f"f_start_{y}").alias("pos"), F.col(f"strand_{y}").alias("strand"), F.col("pair_id")).alias("other"),
    )
    # read three times below, so written once; repeated ends go before the shuffle
    ends = written("ends", contacts.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("x")).select("x.*").distinct())
    sums = ends.groupBy("chr", "pos", "strand").agg(F.count("*").alias("n_ends"), F.countDistinct("other.pair_id").alias("n_groups"))
    busy = sums.filter((F.col("n_ends") > copies) & (F.col("n_groups") > copies))
    few = busy.filter(F.col("n_ends") == copies + 1).select("chr", "pos", "strand")
    partners = ends.join(few, ["chr", "pos", "strand"]).groupBy("chr", "pos", "strand").agg(F.array_sort(F.collect_list("other")).alias("o"))  # copies + 1 each

    def good(x, y):
        near = (x["chr"] == y["chr"]) & (F.abs(x["pos"] - y["pos"]) < resolve)
        clear = (F.col("chr") != x["chr"]) | ((F.abs(F.col("pos") - x["pos"]) > close_cis) & (F.abs(F.col("pos") - y["pos"]) > close_cis))
        return near & clear

    n = copies + 1
    pairs = [good(F.col("o")[i], F.col("o")[j]) for i in range(n) for j in range(i + 1, n)]
    any_good, any_bad = F.lit(False), F.lit(False)
    for p in pairs:
        any_good, any_bad = any_good | p, any_bad | ~p
    judged = partners.select("chr", "pos", "strand", any_bad.alias("remove"), any_good.alias("resolve"))
    return busy.join(judged, ["chr", "pos", "strand"], "left").withColumn("remove", F.coalesce("remove", F.lit(True))).withColumn("resolve", F.coalesce("resolve", F.lit(False)))


def mark_promiscuous(contacts: DataFrame, copies: int = 2) -> DataFrame:
    """contacts with `promiscuity` of their group: promiscuous (before all), resolved, or clean."""
    ends = end_classes(contacts, copies).select("chr", "pos", "strand", "remove", "resolve")
    side = lambda x: F.struct(F.col(f"chr_{x}").alias("chr"), F.col(f"f_start_{x}").alias("pos"), F.col(f"strand_{x}").alias("strand"))
    touched = contacts.select("pair_id", F.explode(F.array(side("a"), side("b"))).alias("x")).select("pair_id", "x.*").join(ends, ["chr", "pos", "strand"])
    groups = touched.groupBy("pair_id").agg(F.max("remove").alias("_r"), F.max("resolve").alias("_s"))
    df = contacts.join(groups, "pair_id", "left")
    kind = F.when(F.col("_r"), "promiscuous").when(F.col("_s"), "resolved").otherwise("clean")
    return df.withColumn("promiscuity", kind).drop("_r", "_s")


def remove_promiscuous(contacts: DataFrame, copies: int = 2) -> DataFrame:
    return mark_promiscuous(contacts, copies).filter("promiscuity <> 'promiscuous'").drop("promiscuity")


def promiscuity_stats(marked: DataFrame) -> DataFrame:
    """(promiscuity, n): groups by class, counted once each."""
    return marked.groupBy("promiscuity").agg(F.countDistinct("pair_id").alias("n"))
