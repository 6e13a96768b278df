"""Row numbers, running sums and runs of equal keys over a whole order, each range of rows by itself.

A window over everything is one task. Here rows are dealt to ranges and sorted there (or are the splits of files, which are
in order already); a narrow pass works out numbers inside each range; one row a range tells what comes before it; and these
few rows are joined back. Neighbouring ranges exchange their border keys in the same rows, so a run that goes over borders,
or fills ranges of its own, is one run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.plan import broadcast_if_small, written

PART, ROW, RUN, KEY = "_part", "_row", "_run", "_key"
Number = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _fields(df: DataFrame, *added: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *added])


def in_ranges(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """df in ranges of `order`, sorted, with _part: the number of its range. Equal rows of `order` share a range."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id())


def _before(totals: DataFrame, by: Sequence[str], order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """totals with each of `sums` turned into the sum over the rows before: a row a range, so one task has few."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*by, *order, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_before_{c}") for c in sums])


def _running(names: Sequence[str], by: Sequence[str]) -> Number:
    """Adds to each of `names` the sums of the rows before it in its range, which `by` tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, last = np.zeros(len(names), np.int64), None
        for rows in batches:
            if not rows.num_rows:
                continue
            new = np.zeros(rows.num_rows, np.bool_)
            for c in by:
                new[1:] |= pc.not_equal(rows.column(c).slice(1), rows.column(c).slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
            first = tuple(rows.column(c)[0].as_py() for c in by)
            new[0] = first != last
            last = tuple(rows.column(c)[rows.num_rows - 1].as_py() for c in by)
            begins = np.flatnonzero(new)
            out = []
            for i, c in enumerate(names):
                sums = np.cumsum(rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64))
                # what stands before each range, minus what came in this batch before it
                less = np.full(rows.num_rows, -carried[i])
                if len(begins):
                    earlier = np.where(begins > 0, sums[begins - 1], 0)
                    less[begins[0] :] = np.repeat(earlier, np.diff([*begins.tolist(), rows.num_rows]))
                sums = sums - less
                carried[i] = sums[-1]
                out.append(pa.array(sums, pa.int64()))
            columns = {**dict(zip(rows.schema.names, rows.columns, strict=True)), **dict(zip(names, out, strict=True))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def running_sums(df: DataFrame, order: Sequence[str], sums: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """df with a column for each of `sums` (whole numbers): its sum over all rows up to and with this one, by `order`."""
    wide = df.withColumns({c: F.coalesce(v.cast("long"), F.lit(0)) for c, v in sums.items()})
    ranged = in_ranges(wide, order, partitions)
    # all columns pass, so the ranges are made once
    table = written("ranges", ranged.withColumns({f"_own_{c}": F.col(c) for c in sums}).mapInArrow(_running(list(sums), [PART]), _fields(ranged, *[f"`_own_{c}` long" for c in sums])))
    totals = table.groupBy(PART).agg(*[F.sum(f"_own_{c}").alias(c) for c in sums])
    before = F.broadcast(_before(totals, [], [PART], list(sums)))  # a row a range
    return table.join(before, PART).select(*df.columns, *[(F.col(c) + F.col(f"_before_{c}")).alias(c) for c in sums])


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "row_no", first: int = 0, partitions: int | None = None) -> DataFrame:
    """df with the row's number, from `first`, by `order` (columns or falling ones), which should leave no ties. No row passes
    through Python."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id())
    table = written("ranges", ranged.withColumn(ROW, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    before = F.broadcast(_before(table.groupBy(PART).agg(F.count("*").alias("n")), [], [PART], ["n"]))  # a row a range
    return table.join(before, PART).select(*df.columns, (F.col(ROW) + F.col("_before_n") + first).alias(name))


def _local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds _row and _run, both from 0 in each range."""
    row, run, last = 0, -1, None
    for rows in batches:
        if not rows.num_rows:
            continue
        key = rows.column(KEY)
        new = np.ones(rows.num_rows, np.int64)
        new[1:] = pc.not_equal(key.slice(1), key.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
        new[0] = last is None or key[0].as_py() != last
        last = key[rows.num_rows - 1].as_py()
        runs = run + np.cumsum(new)
        run = int(runs[-1])
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(row + np.arange(rows.num_rows), pa.int64()), pa.array(runs, pa.int64())], [*rows.schema.names, ROW, RUN])
        row += rows.num_rows


def equal_runs(df: DataFrame, order: Sequence[str], keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """df with row_no, run_no and n_runs: the row's number by `order`, that of its run of equal `keys` (null equals null), both
    from 0, and how many runs there are. Rows that tie in `order` come in any order."""
    # a text that is equal where all keys are: no number or name has these characters
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x1e")) for k in keys])
    ranged = in_ranges(df.withColumn(KEY, text), order, partitions)
    table = written("ranges", ranged.mapInArrow(_local_runs, _fields(ranged, f"{ROW} long", f"{RUN} long")))
    borders = table.groupBy(PART).agg(
        F.min_by(KEY, ROW).alias("_first"), F.max_by(KEY, ROW).alias("_last"), (F.max(RUN) + 1).alias("_runs"), F.count("*").alias("_rows")
    )
    w = Window.orderBy(PART)  # a row a range
    borders = borders.withColumn("_joins", (F.col("_first") == F.lag("_last").over(w)).cast("long"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    borders = borders.select(
        PART,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        (F.coalesce(F.sum("_runs").over(before), F.lit(0)) - F.coalesce(F.sum("_joins").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))).alias("_runs_before"),
        "_runs",
    )
    borders = borders.withColumn("n_runs", F.max(F.col("_runs_before") + F.col("_runs")).over(Window.partitionBy()))
    return table.join(F.broadcast(borders), PART).select(
        *df.columns, (F.col(ROW) + F.col("_rows_before")).alias("row_no"), (F.col(RUN) + F.col("_runs_before")).alias("run_no"), "n_runs"
    )


def file_lines(df: DataFrame) -> DataFrame:
    """df, as read by spark.read.text, with path, _block (where the split begins) and _line (an order inside the split)."""
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"), "value")


def running_in_files(lines: DataFrame, sums: dict[str, Column], joined: bool = False) -> DataFrame:
    """lines (of file_lines) with, for each of `sums`, the sum over the file's lines up to and with this one; `joined`: over all
    files in the order of their paths, as if they were one (the parts of a folder that Spark has written).

    Splits are read twice, once for their totals; lines are neither shuffled nor sorted."""
    wide = lines.withColumns({c: F.coalesce(v.cast("long"), F.lit(0)) for c, v in sums.items()})
    local = wide.mapInArrow(_running(list(sums), ["path", "_block"]), _fields(wide))
    totals = written("splits", wide.groupBy("path", "_block").agg(*[F.sum(c).alias(c) for c in sums]))
    before = _before(totals, [], ["path", "_block"], list(sums)) if joined else _before(totals, ["path"], ["_block"], list(sums))
    before = broadcast_if_small(before, 1 << 20)  # a row a split
    return local.join(before, ["path", "_block"]).select(*lines.columns, *[(F.col(c) + F.col(f"_before_{c}")).alias(c) for c in sums])
