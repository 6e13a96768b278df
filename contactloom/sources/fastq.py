"""FASTQ: scan with exact record numbers, validation, and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line_no, value) of text files, plain or compressed; line_no counts from 0 in each file.

    Lines get a running number inside their split; splits are ordered by file and offset, and the lines before each
    are summed over one row a split. Line text is never shuffled or sorted for it.
    """
    rows = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    splits = rows.groupBy("path", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("path", "_block", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(F.broadcast(offsets), ["path", "_block"]).select("path", (F.col("_id") + F.col("_shift")).alias("line_no"), "value")  # one row a split


def read_fastq(spark: SparkSession, paths: str | list[str], mate: int | None = None) -> DataFrame:
    """(path, mate, read_no, header, seq, plus, qual); leading lines that don't begin with @ are skipped."""
    lines = numbered_lines(spark, paths)
    first = lines.filter(F.startswith("value", F.lit("@"))).groupBy("path").agg(F.min("line_no").alias("_from"))
    at = (F.col("line_no") - F.col("_from")).alias("_at")
    rows = lines.join(F.broadcast(first), "path").select("path", at, F.rtrim(F.col("value"), F.lit("\r")).alias("value")).filter("_at >= 0")  # one row a file
    part = lambda i: F.max(F.when(F.col("_at") % 4 == i, F.col("value")))
    got = rows.groupBy("path", F.floor(F.col("_at") / 4).alias("read_no")).agg(part(0).alias("header"), part(1).alias("seq"), part(2).alias("plus"), part(3).alias("qual"))
    return got.select("path", F.lit(mate).cast("int").alias("mate"), F.col("read_no").cast("long"), "header", "seq", "plus", "qual").filter("qual is not null")


def validate_fastq(lines: DataFrame, head: int = 1 << 16) -> DataFrame:
    """(path, line_no, value) of the wrong lines among the first `head`: headers without @, separators without +."""
    rows = lines.filter((F.col("line_no") < head) & (F.length(F.trim("value")) > 0))
    at = F.col("line_no") % 4
    bad = ((at == 0) & ~F.startswith("value", F.lit("@"))) | ((at == 2) & ~F.startswith("value", F.lit("+")))
    return rows.filter(bad)


def fastq_text(reads: DataFrame) -> DataFrame:
    """One four-line value a read, for write.text (option compression=gzip for .gz)."""
    plus = F.coalesce("plus", F.lit("+")) if "plus" in reads.columns else F.lit("+")
    return reads.select(F.concat_ws("\n", "header", "seq", plus, "qual").alias("value"))


def clipped_headers(reads: DataFrame) -> DataFrame:
    """reads whose headers begin with their ten-digit number."""
    return reads.withColumn("header", F.concat(F.lit("@"), F.format_string("%010d", "read_no"), F.lit("_"), F.substring("header", F.lit(2), F.length("header"))))


def write_demultiplexed(matched: DataFrame, path: str, with_lost: bool = True, compressed: bool = False) -> None:
    """One folder a sample (by code where it has no name); reads without a match go to sample=_lost."""
    df = matched.withColumn("sample", F.coalesce("sample", F.when(F.col("valid"), F.col("match")), F.lit("_lost")))
    if not with_lost:
        df = df.filter("valid")
    out = fastq_text(df).columns
    text = df.select("sample", F.concat_ws("\n", "header", "seq", F.lit("+"), "qual").alias(out[0]))
    text.write.partitionBy("sample").option("compression", "gzip" if compressed else "none").text(path)
