"""Streams of reads: the narrow operators as they are, and running counts of barcodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.operators.clip import ClipSettings, clip


def clip_stream(reads: DataFrame, s: ClipSettings) -> DataFrame:
    """Clipped reads of a stream; no state is held."""
    return clip(reads, s)


def code_counts(reads: DataFrame, time: str = "ts", delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Barcode counts by event-time window; late reads beyond the delay are dropped and their state freed."""
    return reads.withWatermark(time, delay).groupBy(F.window(time, window), "code").agg(F.count("*").alias("n"))
