"""From alignments to final contacts: pairing, filter, duplicates, promiscuous ends, disambiguation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.plan import Keep, written
from contactloom.functions.sites import parse_sizes
from contactloom.operators import classify, contact_stats, dedupe, disambiguate, pairing, promiscuity
from contactloom.plans.config import PipelineConfig

def filtered_contacts(alignments: DataFrame, re1: DataFrame | None, cfg: PipelineConfig, re2: DataFrame | None = None, stars: DataFrame | None = None, names: DataFrame | None = None, keep: Keep = written) -> DataFrame:
    """Tagged contacts of alignments (read_no, end, flag, contig, pos, seq, qual, as_score, md)."""
    s = pairing.PairSettings(scheme=cfg.scheme, report_ambiguous=cfg.report_ambiguous, unique_map=cfg.unique_map, hybrid=cfg.hybrid)
    pairs = keep("paired", pairing.to_contacts(pairing.normalise(alignments, names, cfg.scheme), s))
    lo, hi = parse_sizes(cfg.sizes)
    f = classify.FilterSettings(min_size=lo, max_size=hi, use_re=cfg.enzyme is not None)
    return keep("filtered", classify.filter_pairs(pairs, re1, f, re2, stars))


def final_contacts(filtered: DataFrame, cfg: PipelineConfig, homologs: DataFrame | None = None, keep: Keep = written) -> DataFrame:
    """Accepted contacts without duplicates and, for single cells, without promiscuous ends and unclear pairs."""
    df = filtered.filter("tag = 'accepted'")
    if not (cfg.population and cfg.second_enzyme):
        s = dedupe.DedupeSettings(cfg.min_repeats, cfg.enzyme is not None and cfg.second_enzyme is None, cfg.hybrid, cfg.population)
        df = keep("unique", dedupe.dedupe(df, s))
    if not cfg.population:
        df = keep("clean", promiscuity.remove_promiscuous(df, cfg.n_copies))
    if cfg.hybrid and not cfg.population:
        k = F.row_number().over(Window.partitionBy("pair_id").orderBy("chr_a", "start_a", "chr_b", "start_b")) - 1
        s = disambiguate.DisambiguateSettings(separation=int(cfg.separation_mb * 1e6), ratio=cfg.score_ratio, min_contacts=cfg.min_contacts)
        df = keep("disambiguated", disambiguate.disambiguate(df.withColumn("k", k.cast("long")).withColumn("active", F.lit(True)), s, keep))
    return df


def run_stats(filtered: DataFrame, final: DataFrame, sample: str = "") -> DataFrame:
    """Tidy statistics of the filter and of the final contacts."""
    counts = filtered.groupBy("tag").agg(F.count("*").cast("double").alias("value"))
    total = filtered.agg(F.lit("input_pairs").alias("tag"), F.count("*").cast("double").alias("value"))
    outcome = counts.unionByName(total).select(F.lit(sample).alias("sample"), F.lit("filter").alias("section"), F.lit(0).alias("ord"), F.col("tag").alias("key"), "value")
    return outcome.unionByName(contact_stats.as_stats(contact_stats.contact_stats(final), "final", sample))
