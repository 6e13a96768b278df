"""A corpus pipeline: quality rules, near duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. docs has doc_id, text, lang,
source and n_chars; further columns, also of clashing names, travel with their rows up to packing.

Edge cases, in all stages: an empty table gives an empty one; a null text counts as empty (and goes with the quality
rules, as a text of under ten words); a null doc_id is a row like any other, later than all others; a null lang is held
against the languages' mean. Of repeated rows one stays (the first place); of ties in doc_id, too.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm import ngram_join, packing, quality_rules, secret_scan, suffix_dedup
from contactloom.llm.common import collecting, delete_tables, write_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Tables that the last stage called by itself (not by `run`) has written for itself.
_tables: list[str] = []


def stage(call: Stage) -> Stage:
    """A later stage begins when the one before has been written, so what that one wrote for itself can go. The first
    stage begins a new pipeline and leaves what others have written alone."""

    @wraps(call)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if call.__name__ == "keep_good":
            _tables.clear()
        delete_tables(spark, _tables)
        with collecting(_tables):
            return call(spark, docs, sf_dir)

    return run_stage


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(spark, docs)


@stage
def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least doc_id."""
    return ngram_join.keep_first(spark, docs)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    return suffix_dedup.rewrite(spark, docs)


@stage
def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    return secret_scan.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{c}`") for c in docs.columns])


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return packing.pack(spark, docs, packing.tokenizer_path(packing.TOKENIZER), lasting=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("ngram_jaccard_join", keep_first),
    ("suffix_dedup", cut_repeats),
    ("secret_scans", hide_secrets),
    ("best_fit_packing", pack),
]

#: Tokenizing, MinHash and suffix sorting are beyond SQL; tests/llm/test_pipeline.py holds `run` against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Tables belong to one run: a stage's go when its output has been written, and an output
    when the next one has; those that the result reads stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last: list[str] = []
    for i, (name, call) in enumerate(STAGES):
        own: list[str] = []
        with collecting(own):
            docs = call.__wrapped__(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            output: list[str] = []
            with collecting(output):
                docs = write_table(spark, docs, name)
            delete_tables(spark, own + last)
            last = output
    return docs
