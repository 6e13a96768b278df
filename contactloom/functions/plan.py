"""Plan helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keeps a stage, so that what follows reads its rows instead of making them again.
Keep = Callable[[str, DataFrame], DataFrame]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Made here only where the session has none and runs on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="loom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"


def written(name: str, df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: one pass over its input, however often it is used."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """df with a broadcast hint if it is known to hold at most `rows` rows, else as it is (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def apart(df: DataFrame, *columns: str) -> DataFrame:
    """df with `columns` passed through a generator, which is a step of its own: what is made of them is not unfolded into
    what they are made of, nor are filters on them, and the code that Spark generates for either side stays below the 8000
    bytes of a method that the JVM compiles at most."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*columns)))).select(*df.columns)
