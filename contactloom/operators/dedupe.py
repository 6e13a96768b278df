"""Duplicate removal: one winner for every contact of fragment ends, and the support that its read has gathered."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.ordered import equal_runs


@dataclass(frozen=True)
class DedupeSettings:
    min_repeats: int = 2
    use_fragments: bool = True
    hybrid: bool = False
    population: bool = False
    #: As some older results: duplicates only where equal keys follow one another in the sorted text lines, a run's ties go
    #: by line, the last run counts no repeats, and the first line counts the length of its second end only.
    adjacent_only: bool = False


def keys(s: DedupeSettings) -> list[str]:
    if s.use_fragments and not s.population:
        return ["chr_a", "f_start_a", "strand_a", "chr_b", "f_start_b", "strand_b"]
    return ["chr_a", "start_a", "strand_a", "chr_b", "start_b", "strand_b"]


def _length() -> Column:
    return F.abs(F.col("end_a") - F.col("start_a")) + F.abs(F.col("end_b") - F.col("start_b"))


LINE = ("start_a", "end_a", "start_b", "end_b", "pair_id")


#: The columns of a line, in order.
TEXT = ("chr_a", "start_a", "end_a", "f_start_a", "f_end_a", "strand_a", "chr_b", "start_b", "end_b", "f_start_b", "f_end_b", "strand_b", "pair_id")


def _marked(contacts: DataFrame, s: DedupeSettings, partitions: int | None = None) -> tuple[DataFrame, list[str]]:
    """contacts with winner, run and _counted (the repeats that the winner gets), and the columns that a run's rows share.

    Runs of lines come from ranges of the sorted lines, whose borders are compared afterwards: no chromosome is one task's.
    """
    by, df = keys(s), contacts
    length, ties = _length(), [F.col(c) for c in LINE]
    if s.adjacent_only:
        line = F.concat_ws(" ", *[F.col(c).cast("string") for c in TEXT])
        df = equal_runs(df.withColumn("_line", line), ["_line"], by, partitions)
        by, ties = ["run_no"], [F.col("row_no")]
        length = F.when(F.col("row_no") == 0, F.abs(F.col("end_b") - F.col("start_b"))).otherwise(length)
    w = Window.partitionBy(*by)
    ambiguity = F.col("ambig_size").desc() if s.hybrid else F.col("ambig_size").asc()
    best = F.row_number().over(w.orderBy(ambiguity, length.desc(), *ties))
    df = df.withColumn("winner", best == 1).withColumn("run", F.count("*").over(w))
    last = F.col("run_no") == F.col("n_runs") - 1 if s.adjacent_only else F.lit(False)
    return df.withColumn("_counted", F.when(F.col("winner") & ~last, F.col("run")).otherwise(0)), by


def winners(contacts: DataFrame, s: DedupeSettings = DedupeSettings(), partitions: int | None = None) -> DataFrame:
    """contacts with `winner`, `run` (rows with the same key) per row.

    The winner has the least ambiguity (the greatest where genomes are hybrid), then the longest reads, then the
    first coordinates and pair_id.
    """
    return _marked(contacts, s, partitions)[0].select(*contacts.columns, "winner", "run")


def _gathered(contacts: DataFrame, s: DedupeSettings) -> DataFrame:
    """contacts with, over all rows of a pair_id, _out (it lost a run to another one), _repeats and _size.

    Two windows, by run and by pair_id; no row meets itself in a join.
    """
    won, by = _marked(contacts, s)
    owner = F.max(F.when(F.col("winner"), F.col("pair_id"))).over(Window.partitionBy(*by))
    marked = won.withColumn("_lost", ~F.col("winner") & (owner != F.col("pair_id")))
    mine = Window.partitionBy("pair_id")
    return marked.withColumns({"_out": F.max("_lost").over(mine), "_repeats": F.sum("_counted").over(mine).cast("long"), "_size": F.max("ambig_size").over(mine)}).select(
        *contacts.columns, "_out", "_repeats", "_size"
    )


def dedupe(contacts: DataFrame, s: DedupeSettings = DedupeSettings()) -> DataFrame:
    """Kept contacts with `repeats` and `supported`.

    A pair_id that loses a key to another one is out with all its rows. Single-cell data keeps reads that won
    min_repeats rows for each of their ambiguous places; population data keeps all.
    """
    least = 2 if s.population else s.min_repeats
    kept = _gathered(contacts, s).filter(~F.col("_out"))
    kept = kept.select(*contacts.columns, F.col("_repeats").alias("repeats"), (F.col("_repeats") / F.col("_size") >= least).alias("supported"))
    return kept if s.population else kept.filter("supported")


def dedupe_stats(contacts: DataFrame, s: DedupeSettings = DedupeSettings()) -> DataFrame:
    """One row: reads in, redundant, effective, unique, supported, mean_redundancy."""
    least = 2 if s.population else s.min_repeats
    reads = _gathered(contacts, s).groupBy("pair_id").agg(*[F.max(f"_{c}").alias(c) for c in ("out", "repeats", "size")])
    kept = ~F.col("out")
    enough = F.col("repeats") / F.col("size") >= least
    return reads.agg(
        F.count("*").alias("input_reads"),
        F.count_if(~kept).alias("redundant"),
        F.count_if(kept).alias("effective"),
        F.count_if(kept & ~enough).alias("unique_reads"),
        F.count_if(kept & enough).alias("supported"),
        F.round(F.sum(F.when(kept, F.col("repeats"))) / F.count_if(kept), 6).alias("mean_redundancy"),
    )
