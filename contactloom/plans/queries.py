"""Registered queries of the contact engine and their SQL twins.

A query applies operators to the derived tables of `views`; its twin is written independently in DuckDB's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom.functions import sites
from contactloom.functions.plan import written
from contactloom.operators import assign, barcodes, classify, clip, contact_map, contact_stats, dedupe, digest, disambiguate, pairing, promiscuity
from contactloom.plans import views

SIZES = classify.FilterSettings(min_size=200, max_size=450)
CLIP = clip.ClipSettings(sites.junction("^GATC_"), sites.recognition("^GATC_"))
PLACE = disambiguate.DisambiguateSettings(separation=50_000, min_contacts=1, ratio=1.2)


def _tagged(spark: SparkSession, d: str, s=SIZES, re2: bool = False, together: bool = True) -> DataFrame:
    return classify.filter_pairs(views.contacts(spark, d, together), views.fragments(spark), s, views.fragments_2(spark) if re2 else None)


def _accepted(spark: SparkSession, d: str) -> DataFrame:
    return _tagged(spark, d).filter("tag = 'accepted'")


def _numbered(spark: SparkSession, d: str) -> DataFrame:
    """Accepted contacts with homologs (chr1.a, chr1.b), places in groups, and all rows active: the columns that tell where they are."""
    df = _accepted(spark, d)
    name = lambda x: F.when(F.col(f"chr_{x}") == "chr3", "chr1.b").when(F.col(f"chr_{x}") == "chr1", "chr1.a").otherwise(F.col(f"chr_{x}"))
    k = F.row_number().over(Window.partitionBy("pair_id").orderBy("start_a", "start_b", "strand_a", "strand_b", "chr_a", "chr_b")) - 1
    df = df.withColumn("chr_a", name("a")).withColumn("chr_b", name("b")).withColumn("k", k.cast("long")).withColumn("active", F.lit(True))
    return df.select("pair_id", "k", *[f"{c}_{x}" for x in "ab" for c in ("chr", "f_start", "f_end", "strand")], "active")


def f_filter_counts(spark, d):
    return classify.filter_counts(_tagged(spark, d))


def f_filter_counts_re2(spark, d):
    return classify.filter_counts(_tagged(spark, d, re2=True))


def f_filter_counts_no_re(spark, d):
    s = classify.FilterSettings(min_size=20, max_size=170, use_re=False)
    return classify.filter_counts(_tagged(spark, d, s))


def f_filtered_rows(spark, d):
    return _tagged(spark, d).select("pair_id", "line_no", "chr_a", "start_a", "chr_b", "start_b", "f_start_a", "f_end_a", "f_start_b", "f_end_b", "size", "tag", "separation")


def f_separations(spark, d):
    return classify.separations(_tagged(spark, d, together=False))  # no groups


def f_size_histogram(spark, d):
    return classify.size_histogram(_tagged(spark, d))


def f_junction_histogram(spark, d):
    return classify.junction_histogram(_tagged(spark, d, together=False))  # no groups


def c4_asof_fragment(spark, d):
    rows = views.contacts(spark, d).select("pair_id", "line_no", "chr_a", "end_a")
    return assign.to_fragment(rows, views.fragments(spark), "chr_a", "end_a", ("idx", "f_start", "f_end"))


def c5_asof_star(spark, d):
    rows = views.contacts(spark, d).select("pair_id", "line_no", "chr_a", "start_a", "strand_a")
    stars = views.fragments_2(spark).select("chr", F.col("frag_start").alias("pos"))
    return assign.to_star(rows, stars, "chr_a", "start_a", "strand_a", "star")


def g1_dedupe(spark, d):
    return dedupe.dedupe(_accepted(spark, d), dedupe.DedupeSettings()).select("pair_id", "line_no", "start_a", "start_b", "repeats")


def g2_dedupe_stats(spark, d):
    return dedupe.dedupe_stats(_accepted(spark, d))


def g1_dedupe_hybrid_population(spark, d):
    s = dedupe.DedupeSettings(hybrid=True, population=True)
    return dedupe.dedupe(_accepted(spark, d), s).select("pair_id", "line_no", "start_a", "start_b", "repeats", "supported")


def g3_promiscuous_ends(spark, d):
    return promiscuity.end_classes(_accepted(spark, d)).select("chr", "pos", "strand", "n_ends", "n_groups", "remove", "resolve")


def g4_promiscuity_stats(spark, d):
    return promiscuity.promiscuity_stats(promiscuity.mark_promiscuous(written("accepted", _accepted(spark, d))))


def g5_contact_stats(spark, d):
    return contact_stats.contact_stats(_accepted(spark, d))


def g13_quartile_edges(spark, d):
    return contact_stats.quartile_edges(classify.size_histogram(_tagged(spark, d)))


def g14_sample_table(spark, d):
    tagged = _tagged(spark, d).withColumn("sample", F.concat(F.lit("s"), (F.col("pair_id") % 4).cast("string")))
    counts = tagged.groupBy("sample", F.col("tag").alias("key")).agg(F.count("*").cast("double").alias("value"))
    total = tagged.groupBy("sample").agg(F.lit("input_pairs").alias("key"), F.count("*").cast("double").alias("value"))
    return contact_stats.sample_table(counts.unionByName(total.select("sample", "key", "value")).withColumn("section", F.lit("filter"))).select("sample", "pc_accepted", "pc_other")


def _reads(spark, d):
    return views.view(spark, d, views.READS, "orders")


def b_clipped_reads(spark, d):
    return clip.clip(_reads(spark, d), CLIP).select("read_no", "seq", "qual")


def b10_clip_stats(spark, d):
    return clip.clip_stats(clip.clip_all(_reads(spark, d), CLIP))


def b11_junction_positions(spark, d):
    return clip.position_histogram(clip.clip_all(_reads(spark, d), CLIP), "junction_at")


def b12_quality_scheme(spark, d):
    return clip.quality_scheme(_reads(spark, d))


#: Bases of a block in queries: the tables' contigs have up to 0.1 million bases, so most of them go over several blocks.
SMALL = 1 << 12


def d1_fragments(spark, d):
    return digest.fragments(views.view(spark, d, views.CONTIGS["spark"], "documents"), "^GATC_", block=SMALL)


def d2_star_sites(spark, d):
    return digest.star_sites(views.view(spark, d, views.CONTIGS["spark"], "documents"), ["^GATC_", "^AATN_"], block=SMALL)


def d4_windows(spark, d):
    return digest.windows(views.view(spark, d, views.CONTIGS["spark"], "documents"), 200, 150, block=SMALL).select("contig", "start", "end", "lead", "tail", F.md5("window").alias("window_md5"))


def _alignments(spark, d):
    return views.alignments(spark, d)


def e1_normalised(spark, d):
    return pairing.normalise(_alignments(spark, d)).select("read_no", F.col("end").alias("mate"), "aln.chr", "aln.start", F.col("aln.end").alias("stop"), "aln.strand", "aln.score")


def e9_pair_stats(spark, d):
    return pairing.pair_stats(pairing.pair_reads(pairing.normalise(_alignments(spark, d))))


def e8_contacts(spark, d):
    return pairing.to_contacts(pairing.normalise(_alignments(spark, d))).groupBy("pair_id").agg(
        F.count("*").alias("rows_out"), F.max("ambig_size").alias("ambig_size"), F.sum("swap_pair").alias("swapped"), F.sum(F.col("start_a") + F.col("start_b") + F.col("end_a") + F.col("end_b")).alias("places"), F.sum("marker").alias("marker")
    )


def c3_unpaired(spark, d):
    return pairing.unpaired(pairing.normalise(_alignments(spark, d))).withColumnRenamed("end", "mate")


def a17_mapping_stats(spark, d):
    return contact_stats.mapping_stats(_alignments(spark, d))


def _codes(spark, d):
    return views.view(spark, d, views.BARCODED, "events"), views.view(spark, d, views.CODES, "customer")


def c16_demultiplex(spark, d):
    reads, codes = _codes(spark, d)
    return barcodes.demultiplex(reads, codes, 1).select("read_no", "code", "match", "sample", "distance", "valid")


def g6_code_counts(spark, d):
    return barcodes.count_codes(_codes(spark, d)[0])


def g6_levels(spark, d):
    return barcodes.level_counts(barcodes.count_codes(_codes(spark, d)[0]))


def g7_demux_stats(spark, d):
    reads, codes = _codes(spark, d)
    return barcodes.demux_stats(barcodes.demultiplex(reads, codes, 1))


def a24_sample_names(spark, d):
    reads, codes = _codes(spark, d)
    return barcodes.name_samples(barcodes.count_codes(reads), codes)


def g8_simple_demux(spark, d):
    df = _reads(spark, d)
    pairs = df.select("read_no", F.col("seq").alias("seq_1"), F.col("qual").alias("qual_1"), F.when(F.col("read_no") % 3 == 0, F.reverse("seq")).otherwise(F.col("seq")).alias("seq_2"), F.col("qual").alias("qual_2"))
    return barcodes.demultiplex_simple(pairs)[1]


def g9_pair_counts(spark, d):
    return disambiguate.pair_counts(disambiguate.load(_numbered(spark, d), PLACE))


def i1_loaded(spark, d):
    return disambiguate.load(_numbered(spark, d), PLACE)


def i2_network_scores(spark, d):
    df = disambiguate.load(_numbered(spark, d), PLACE)
    lone = df.filter("n = 1")
    return disambiguate.network_scores(df, lone, PLACE).withColumn("score", F.round("score", 6))


def i3_dense_homologs(spark, d):
    return disambiguate.dense_homologs(disambiguate.load(_numbered(spark, d), PLACE), PLACE).groupBy("pair_id").agg(F.count("*").alias("rows_in"), F.count_if("keep").alias("kept"))


def i4_without_isolated(spark, d):
    return disambiguate.remove_isolated(_numbered(spark, d), PLACE).groupBy("pair_id").agg(F.count_if("active").alias("kept"))


def i5_missing_cis(spark, d):
    """chr2 is made rare by counting nearly all of its cis pairs to another chromosome."""
    df = disambiguate.load(_numbered(spark, d), PLACE)
    moved = (F.col("chr_a") == "chr2") & (F.col("chr_b") == "chr2") & (F.col("pair_id") % 5000 != 1)
    other = lambda c: F.when(moved, "chr1.a").otherwise(F.col(c)).alias(c)
    return disambiguate.missing_cis(df.select(*[other(c) if c in ("chr_a", "chr_b") else c for c in df.columns]), PLACE)


def i7_trans_relay(spark, d):
    return disambiguate.trans_relay(disambiguate.load(_numbered(spark, d), PLACE), PLACE).withColumn("relay", F.round("relay", 6))


def i8_resolved(spark, d):
    return disambiguate.resolve(_numbered(spark, d), PLACE).groupBy("pair_id").agg(F.count("*").alias("rows_in"), F.count_if("active").alias("kept"))


def j1_contact_map(spark, d):
    return contact_map.contact_map(contact_map.positions(_accepted(spark, d)), 100_000)


def j2_contact_probability(spark, d):
    return contact_map.contact_probability(contact_map.positions(_accepted(spark, d)))


def j3_trans_density(spark, d):
    return contact_map.trans_density(contact_map.positions(_accepted(spark, d)))


def j3_isolated(spark, d):
    return contact_map.isolated_fraction(contact_map.positions(_accepted(spark, d)), 20_000)


def j4_chromosome_limits(spark, d):
    return contact_map.chromosome_limits(contact_map.positions(_accepted(spark, d)))


_NAMES = """f_filter_counts f_filter_counts_re2 f_filter_counts_no_re f_filtered_rows f_separations f_size_histogram f_junction_histogram
c4_asof_fragment c5_asof_star g1_dedupe g2_dedupe_stats g1_dedupe_hybrid_population g3_promiscuous_ends g4_promiscuity_stats g5_contact_stats
g13_quartile_edges g14_sample_table b_clipped_reads b10_clip_stats b11_junction_positions b12_quality_scheme d1_fragments d2_star_sites d4_windows
e1_normalised e9_pair_stats e8_contacts c3_unpaired a17_mapping_stats c16_demultiplex g6_code_counts g6_levels g7_demux_stats a24_sample_names
g8_simple_demux g9_pair_counts i1_loaded i2_network_scores i3_dense_homologs i4_without_isolated i5_missing_cis i7_trans_relay i8_resolved
j1_contact_map j2_contact_probability j3_trans_density j3_isolated j4_chromosome_limits"""
QUERIES: dict = {n: globals()[n] for n in _NAMES.split()}

from contactloom.plans import file_queries  # noqa: E402
from contactloom.plans.oracle import ORACLE as PLAIN  # noqa: E402

QUERIES |= file_queries.QUERIES
ORACLE: dict[str, str] = PLAIN | file_queries.ORACLE
