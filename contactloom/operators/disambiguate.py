"""Disambiguation of contacts in diploid data, by support from contacts nearby.

Contacts are rows (pair_id, k, chr_a, f_start_a, f_end_a, strand_a, .._b, active): a group is all rows of a pair_id,
an unambiguous contact is a group with one active row. Neighbourhoods are 3 x 3 bins: equal contacts are
one row with a count, which is sent to its nine bins and meets the places there by equality of (chr_a, chr_b, bin_a, bin_b).
A bin's sums are made over the ends that differ (functions/neighbours.py); `slices` deals a crowded bin to several tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.neighbours import sums_around
from contactloom.functions.plan import Keep, broadcast_if_small, written

MIN_SEPARATION = 100


@dataclass(frozen=True)
class DisambiguateSettings:
    separation: int = 40_000_000
    isolation: float = 0.01
    density: float = 0.90
    ratio: float = 10.0
    max_pairs: int = 16
    primary_weight: int = 5
    relay_percentile: float = 0.05
    min_contacts: int = 100_000
    drop_position_ambiguous: bool = False
    slices: int = 1


def load(contacts: DataFrame, s: DisambiguateSettings) -> DataFrame:
    """Active rows (pair_id, k, chr_a, chr_b, pos_a, pos_b, bin_a, bin_b, n): positions at the ligation junction, ends
    in order of chromosome names, n active rows in the group."""
    at = lambda x: F.when(F.col(f"strand_{x}") == "+", F.col(f"f_end_{x}")).otherwise(F.col(f"f_start_{x}"))
    df = contacts.filter("active").select("pair_id", "k", "chr_a", "chr_b", at("a").alias("_pa"), at("b").alias("_pb"))
    swap = F.col("chr_a") > F.col("chr_b")
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    df = df.select("pair_id", "k", pick("chr_a", "chr_b").alias("chr_a"), pick("chr_b", "chr_a").alias("chr_b"), pick("_pa", "_pb").alias("pos_a"), pick("_pb", "_pa").alias("pos_b"))
    bins = [F.floor(F.col(f"pos_{x}") / s.separation).cast("long").alias(f"bin_{x}") for x in "ab"]
    return df.select("*", *bins, F.count("*").over(Window.partitionBy("pair_id")).alias("n"))


def position_ambiguous(loaded: DataFrame) -> DataFrame:
    """(pair_id) of groups with over four distinct ends, or over two chromosome roots."""
    ends = loaded.select("pair_id", F.explode(F.array(*[F.struct(F.col(f"chr_{x}").alias("chr"), F.col(f"pos_{x}").alias("pos")) for x in "ab"])).alias("e"))
    root = F.split("e.chr", r"\.")[0]
    sums = ends.groupBy("pair_id").agg(F.countDistinct("e").alias("ends"), F.countDistinct(root).alias("roots"))
    return sums.filter("ends > 4 or roots > 2").select("pair_id")


def _around(queries: DataFrame, contacts: DataFrame, s: DisambiguateSettings, kernels: bool) -> DataFrame:
    """(chr_a, chr_b, pos_a, pos_b, met, around, lo, hi) of the places of `queries` that have contacts in their 3 x 3 bins."""
    key = ["chr_a", "chr_b", "bin_a", "bin_b", "_slice"]
    places = queries.select("chr_a", "chr_b", "pos_a", "pos_b", "bin_a", "bin_b").distinct().withColumn("_slice", F.pmod(F.xxhash64("pos_a"), F.lit(s.slices)).cast("int"))
    # one row for all contacts of a place
    others = contacts.groupBy("chr_a", "chr_b", "pos_a", "pos_b", "bin_a", "bin_b").agg(F.count("*").alias("w"))
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    others = others.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps)).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(s.slices - 1))))
    # the bin of the places that meet it, and how far the contact's own bin is from there
    others = others.withColumn("bin_a", F.col("bin_a") - F.col("_i")).withColumn("bin_b", F.col("bin_b") - F.col("_j"))
    # names of their own, as both sides may come from one table
    others = others.select(*[F.col(c).alias(f"o_{c}") for c in others.columns])

    def sums(q: pa.Table, o: pa.Table) -> pa.Table:
        ints = lambda df, *names: [df.column(c).to_numpy() for c in names]
        pos_a, pos_b = ints(q, "pos_a", "pos_b")
        i, j, p, r, w = ints(o, "o__i", "o__j", "o_pos_a", "o_pos_b", "o_w")
        bins = {}
        for at in {*zip(i.tolist(), j.tolist(), strict=True)}:
            in_bin = (i == at[0]) & (j == at[1])
            bins[at] = (p[in_bin], r[in_bin], w[in_bin].astype(float))
        met, around, lo, hi = sums_around(pos_a, pos_b, bins, s.separation, MIN_SEPARATION, kernels)
        out = [*(q.column(c) for c in ("chr_a", "chr_b", "pos_a", "pos_b")), pa.array(met.astype("int64")), pa.array(around.astype("int64")), pa.array(lo), pa.array(hi)]
        return pa.table(dict(zip(("chr_a", "chr_b", "pos_a", "pos_b", "met", "around", "lo", "hi"), out, strict=True))).filter(pa.array(met > 0))

    fields = "chr_a string, chr_b string, pos_a long, pos_b long, met long, around long, lo double, hi double"
    return places.groupBy(*key).cogroup(others.groupBy(*[f"o_{c}" for c in key])).applyInArrow(sums, fields)


def network_scores(queries: DataFrame, contacts: DataFrame, s: DisambiguateSettings) -> DataFrame:
    """(chr_a, chr_b, pos_a, pos_b, score) for distinct query places: log10 of (1 + kernel sum below) * (1 + sum above),
    at most 8, over unambiguous contacts; places without any are left out."""
    score = F.round(F.least(F.lit(8.0), F.log10((1 + F.col("lo")) * (1 + F.col("hi")))), 9).alias("score")
    return _around(queries, contacts, s, True).select("chr_a", "chr_b", "pos_a", "pos_b", score)


def _root(c: Column) -> Column:
    return F.split(c, r"\.")[0]


def dense_homologs(loaded: DataFrame, s: DisambiguateSettings) -> DataFrame:
    """loaded with `keep`: trans pairs between homologs stay only in ambiguous groups, and where their bin and its
    surroundings hold fewer contacts than the given quantile of bins between chromosomes of one root."""
    key = ["chr_a", "chr_b", "bin_a", "bin_b"]
    counts = loaded.filter(_root(F.col("chr_a")) == _root(F.col("chr_b"))).groupBy(*key).agg(F.count("*").alias("own"))
    limit = counts.agg(F.percentile("own", s.density).alias("limit"))
    homolog = (F.col("chr_a") != F.col("chr_b")) & (_root(F.col("chr_a")) == _root(F.col("chr_b")))
    around = _around(loaded.filter(homolog), loaded.filter(homolog), s, False).filter("around > 0").select("chr_a", "chr_b", "pos_a", "pos_b", "around")
    df = loaded.join(counts, key, "left").join(around, ["chr_a", "chr_b", "pos_a", "pos_b"], "left").crossJoin(F.broadcast(limit))  # one row
    sparse = F.col("own") + F.coalesce("around", F.lit(0)) < F.col("limit")
    return df.select(*loaded.columns, F.when(homolog, sparse & (F.col("n") > 1)).otherwise(F.lit(True)).alias("keep"))


def remove_isolated(contacts: DataFrame, s: DisambiguateSettings = DisambiguateSettings(), keep: Keep = written) -> DataFrame:
    """First stage: contacts with `active` cleared for dense homolog pairs and for isolated unambiguous contacts."""
    loaded = keep("loaded", load(contacts, s))
    kept = keep("dense", dense_homologs(loaded, s).withColumn("m", F.sum(F.col("keep").cast("int")).over(Window.partitionBy("pair_id"))))
    single = kept.filter((F.col("m") == 1) & F.col("keep"))
    lone = kept.filter((F.col("n") == 1) & F.col("keep"))
    own = lone.select("chr_a", "chr_b", "bin_a", "bin_b").distinct().withColumn("_own", F.lit(True))
    scored = single.join(own, ["chr_a", "chr_b", "bin_a", "bin_b"], "left").join(network_scores(single, lone, s), ["chr_a", "chr_b", "pos_a", "pos_b"], "left")
    score = F.when(F.col("_own"), F.coalesce("score", F.lit(0.0))).otherwise(0.0)
    isolated = scored.filter(score < s.isolation).select("pair_id").distinct().withColumn("_iso", F.lit(True))
    state = kept.join(isolated, "pair_id", "left")
    # groups left with one pair stay as ambiguous as they were, unless that pair is isolated
    out = F.when(F.col("_iso").isNotNull() | (F.col("m") == 0), False).when((F.col("m") < F.col("n")) & (F.col("m") > 1), F.col("keep")).otherwise(True)
    return _apply(contacts, state.select("pair_id", "k", out.alias("_on")))


def _apply(contacts: DataFrame, state: DataFrame) -> DataFrame:
    df = contacts.join(state, ["pair_id", "k"], "left")
    return df.select(*[c for c in contacts.columns if c != "active"], (F.col("active") & F.coalesce("_on", F.lit(False))).alias("active")).select(*contacts.columns)


def pair_counts(loaded: DataFrame) -> DataFrame:
    """(chr_a, chr_b, n_unambig) over unambiguous contacts."""
    return loaded.filter("n = 1").groupBy("chr_a", "chr_b").agg(F.count("*").alias("n_unambig"))


def missing_cis(loaded: DataFrame, s: DisambiguateSettings) -> DataFrame:
    """(chr): chromosomes with fewer unambiguous cis contacts than the primary weight."""
    chroms = loaded.select(F.explode(F.array("chr_a", "chr_b")).alias("chr")).distinct()
    cis = pair_counts(loaded).filter("chr_a = chr_b").select(F.col("chr_a").alias("chr"), "n_unambig")
    return chroms.join(cis, "chr", "left").filter(F.coalesce("n_unambig", F.lit(0)) < s.primary_weight).select("chr")


def trans_relay(loaded: DataFrame, s: DisambiguateSettings) -> DataFrame:
    """(chr_a, chr_b, relay): weighted direct contacts and, by a join on the third chromosome, indirect ones."""
    counts = pair_counts(loaded).filter("chr_a <> chr_b")
    both = counts.unionByName(counts.select(F.col("chr_b").alias("chr_a"), F.col("chr_a").alias("chr_b"), "n_unambig"))
    x = both.select(F.col("chr_a").alias("_a"), F.col("chr_b").alias("_c"), F.col("n_unambig").alias("_m"))
    y = both.select(F.col("chr_a").alias("_b"), F.col("chr_b").alias("_d"), F.col("n_unambig").alias("_o"))
    via = x.join(y, (x["_c"] == y["_d"]) & (x["_a"] < y["_b"])).select(F.col("_a").alias("chr_a"), F.col("_b").alias("chr_b"), F.sqrt(F.col("_m") * F.col("_o")).alias("v"))
    direct = counts.select("chr_a", "chr_b", (s.primary_weight * F.col("n_unambig")).cast("double").alias("v"))
    return via.unionByName(direct).groupBy("chr_a", "chr_b").agg(F.round(F.sum("v"), 9).alias("relay"))


def relay_limit(relay: DataFrame, s: DisambiguateSettings) -> DataFrame:
    """One row: the quantile of relays, each pair of chromosomes counted both ways."""
    v = relay.filter("relay > 0").select(F.explode(F.array("relay", "relay")).alias("v"))
    return v.agg(F.percentile("v", s.relay_percentile).alias("limit"))


def supported(loaded: DataFrame, s: DisambiguateSettings) -> DataFrame:
    """(pair_id, k, chr_a, chr_b, score) of the rows of ambiguous groups: support by unambiguous contacts nearby, zero
    where the row's own bin has none."""
    lone = loaded.filter("n = 1")
    many = loaded.filter((F.col("n") > 1) & (F.col("n") <= s.max_pairs))
    own = lone.select("chr_a", "chr_b", "bin_a", "bin_b").distinct().withColumn("_own", F.lit(True))
    df = many.join(own, ["chr_a", "chr_b", "bin_a", "bin_b"], "left").join(network_scores(many, lone, s), ["chr_a", "chr_b", "pos_a", "pos_b"], "left")
    score = F.when(F.col("_own").isNotNull(), F.coalesce("score", F.lit(0.0))).otherwise(0.0)
    return df.select("pair_id", "k", "chr_a", "chr_b", score.alias("score"))


def network_filter(
    contacts: DataFrame, s: DisambiguateSettings, missing: DataFrame, relay: DataFrame | None = None, drop_isolated: bool = False,
    loaded: DataFrame | None = None, scores: DataFrame | None = None,
) -> DataFrame:
    """contacts with `active` narrowed in ambiguous groups, by ranking the support of their pairs.

    loaded and scores are load(contacts) and supported(loaded), where they are kept already."""
    loaded = load(contacts, s) if loaded is None else loaded
    df = supported(loaded, s) if scores is None else scores
    df = df.join(broadcast_if_small(missing.select(F.col("chr").alias("_m"))), (F.col("chr_a") == F.col("_m")) & (F.col("chr_b") == F.col("_m")), "left")
    gone = F.col("_m").isNotNull()
    possible = ~gone
    if relay is not None:
        df = df.join(broadcast_if_small(relay), ["chr_a", "chr_b"], "left").crossJoin(F.broadcast(relay_limit(relay, s)))  # one row
        direct = F.col("chr_a") != F.col("chr_b")
        # chromosomes without any relay have none, and so too little
        possible = possible & (~direct | (F.coalesce("relay", F.lit(0.0)) >= F.coalesce("limit", F.lit(0.0))))
    df = df.select("pair_id", "k", F.when(gone, 0.0).otherwise(F.col("score")).alias("s"), possible.alias("ok"))
    groups = df.groupBy("pair_id").agg(F.sort_array(F.collect_list(F.struct("s", "k", "ok")), asc=False).alias("p"))  # at most max_pairs
    at = lambda i: F.coalesce(F.get("p", F.lit(i))["s"], F.lit(0.0))
    ok = F.filter("p", lambda x: x["ok"])
    ks = lambda a: F.transform(a, lambda x: x["k"])
    top = lambda i: ks(F.slice("p", 1, i))
    none, every = F.expr("cast(array() as array<bigint>)"), ks(F.col("p"))
    partly = (F.size(ok) > 0) & (F.size(ok) < F.size("p"))
    tentative = F.when(partly, ks(ok)).otherwise(every)
    keep = (
        F.when(partly & (F.size(ok) == 1), F.when(ok[0]["s"] > 0, ks(ok)).otherwise(none))
        .when(at(0) < 1.0, none if drop_isolated else tentative)
        .when(at(0) > s.ratio * at(1), top(1))
        .when(at(1) > s.ratio * at(2), top(2))
        .when(at(2) > s.ratio * at(3), top(3))
        .otherwise(tentative)
    )
    chosen = groups.select("pair_id", keep.alias("keep"))
    state = loaded.join(chosen, "pair_id", "left")
    on = F.when(F.col("n") == 1, True).when(F.col("n") > s.max_pairs, False).otherwise(F.array_contains("keep", F.col("k")))
    return _apply(contacts, state.select("pair_id", "k", on.alias("_on")))


def resolve(contacts: DataFrame, s: DisambiguateSettings = DisambiguateSettings(), keep: Keep = written) -> DataFrame:
    """Second stage, in two passes: a light one gives the relay between chromosomes, which the second one also uses.

    Both rank the same scores, which are made once; what is used more than once is kept (written, by default)."""
    contacts = keep("contacts", contacts)
    loaded = keep("loaded", load(contacts, s))
    missing = keep("missing", missing_cis(loaded, s))
    scores = keep("scores", supported(loaded, s))
    first = network_filter(contacts, s, missing, loaded=loaded, scores=scores)
    relay = keep("relay", trans_relay(load(first, s), s))
    out = network_filter(contacts, s, missing, relay, drop_isolated=True, loaded=loaded, scores=scores)
    if s.drop_position_ambiguous:
        bad = position_ambiguous(loaded).withColumn("_bad", F.lit(True))
        names = out.columns
        out = out.join(bad, "pair_id", "left").withColumn("active", F.col("active") & F.col("_bad").isNull()).select(*names)
    return out


def disambiguate(contacts: DataFrame, s: DisambiguateSettings = DisambiguateSettings(), keep: Keep = written) -> DataFrame:
    """Both stages; data with fewer groups than min_contacts only has the first one."""
    contacts = keep("input", contacts)
    first = keep("first", remove_isolated(contacts, s, keep))
    if contacts.filter("active").select("pair_id").distinct().count() < s.min_contacts:
        return first
    return resolve(first, s, keep)
