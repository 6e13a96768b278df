"""Names and pairs of files: driver-side helpers for the few files of a run, and the same for tables of any number of paths."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class FileError(ValueError):
    """Files that can't be used or paired."""


def split_extension(path: str, compressed: tuple[str, ...] = (".gz", ".gzip")) -> tuple[str, str]:
    root, ext = os.path.splitext(path)
    if ext in compressed:
        root, inner = os.path.splitext(root)
        ext = inner + ext
    return root, ext


def tagged(path: str, tag: str, extension: str | None = None, sep: str = "_") -> str:
    """path with a tag before its extension."""
    root, ext = split_extension(path)
    return f"{root}{sep}{tag}{ext if extension is None else extension}"


def with_extension(path: str, extension: str) -> str:
    ext = extension if extension.startswith(".") else "." + extension
    return path if path.endswith(ext) else os.path.splitext(path)[0] + ext


def merged_root(first: str, second: str, sep: str = "_") -> str:
    """A common root of two file names: tokens that differ are both kept."""
    a, b = (re.split(r"[_.]", split_extension(os.path.basename(p))[0]) for p in (first, second))
    out = []
    for i in range(max(len(a), len(b))):
        x, y = a[i : i + 1], b[i : i + 1]
        out += x if x == y else x + y
    return os.path.join(os.path.dirname(first), sep.join(out))


def fragment_file(index: str, enzyme: str) -> str:
    return f"{index}_re_frags_{enzyme}.txt"


def pair_files(paths: Iterable[str], tags: tuple[str, str] = ("r_1", "r_2")) -> list[tuple[str, str]]:
    """(first mate, second mate) of all paths; each name holds exactly one of the tags."""
    paths = list(paths)
    if len(set(paths)) != len(paths):
        raise FileError("a file is given twice")
    sides: dict[bool, set[str]] = {True: set(), False: set()}
    for p in paths:
        has = [t in os.path.basename(p) for t in tags]
        if sum(has) != 1:
            raise FileError(f"{p} must have exactly one of the tags {tags}")
        sides[has[0]].add(p)
    out = []
    for p in sorted(sides[True]):
        mate = os.path.join(os.path.dirname(p), os.path.basename(p).replace(tags[0], tags[1]))
        if mate not in sides[False]:
            raise FileError(f"{p} has no partner {mate}")
        sides[False].remove(mate)
        out.append((p, mate))
    if sides[False]:
        raise FileError(f"no partner for {sorted(sides[False])}")
    return out


def check_regular(path: str) -> str:
    """The path of a file that is there, regular, readable and not empty."""
    if not os.path.exists(path):
        raise FileError(f"{path} does not exist")
    if not os.path.isfile(path):
        raise FileError(f"{path} is not a regular file")
    if os.stat(path).st_size == 0:
        raise FileError(f"{path} is empty")
    if not os.access(path, os.R_OK):
        raise FileError(f"{path} is not readable")
    return path


def root_and_extension(path: Column) -> tuple[Column, Column]:
    """As split_extension, of a column."""
    parts = r"^(.*?[^/])((?:\.[^./]*)?(?:\.gz|\.gzip)|\.[^./]*)?$"
    return F.regexp_extract(path, parts, 1), F.regexp_extract(path, parts, 2)


def merged_roots(first: Column, second: Column, sep: str = "_") -> Column:
    """As merged_root, of columns."""
    name = lambda p: F.split(F.element_at(F.split(root_and_extension(p)[0], "/"), -1), "[_.]")
    both = F.zip_with(name(first), name(second), lambda x, y: F.when(x.eqNullSafe(y), F.array(x)).otherwise(F.array_compact(F.array(x, y))))
    return F.concat(F.regexp_extract(first, "^(.*/)?", 0), F.array_join(F.flatten(both), sep))


def pair_table(paths: DataFrame, tags: tuple[str, str] = ("r_1", "r_2")) -> DataFrame:
    """(first, second, error) of a table of distinct paths (path): mates joined by name, and for a path that can't be paired, why."""
    name = F.element_at(F.split("path", "/"), -1)
    folder = F.regexp_extract("path", "^(.*/)?", 0)
    has = [F.contains(name, F.lit(t)) for t in tags]
    df = paths.select("path", has[0].alias("_1"), has[1].alias("_2"), F.concat(folder, F.replace(name, F.lit(tags[0]), F.lit(tags[1]))).alias("_mate"))
    odd = df.filter(F.col("_1") == F.col("_2")).select(F.col("path").alias("first"), F.lit(None).cast("string").alias("second"), F.lit("one tag wanted").alias("error"))
    a, b = df.filter("_1 and not _2").select(F.col("path").alias("first"), "_mate"), df.filter("_2 and not _1").select(F.col("path").alias("second"))
    met = a.join(b, F.col("_mate") == F.col("second"), "full")
    alone = F.when(F.col("first").isNull() | F.col("second").isNull(), F.lit("no partner"))
    return met.select("first", "second", alone.alias("error")).unionByName(odd)
