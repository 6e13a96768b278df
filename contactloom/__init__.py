"""Spark-native analytics for paired-read chromosome contacts."""

__version__ = "0.1.0"
