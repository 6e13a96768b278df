"""Run statistics: tidy table to JSON sections and back, log lines, and report values. Small driver-side data."""

from __future__ import annotations

import json
import os
import textwrap

from pyspark.sql import DataFrame, SparkSession

#: Keys of older statistics and what they are called now.
RENAMED = {"excluded_ambig_group": "excluded_group", "defunct_ambig_group": "redundant_contacts"}


def format_value(value: float | int, total: float | None = None) -> str:
    """A number with thousands separators, and its percentage of a total."""
    text = f"{int(value):,}" if float(value).is_integer() else f"{value:,.3f}"
    if total is None:
        return text
    return f"{text} ({100.0 * value / total:.2f} %)" if total else f"{text} (0.00 %)"


def write_stats(stats: DataFrame, path: str) -> dict:
    """Merge tidy stats (section, ord, key, value) of one sample into a JSON file, section by section."""
    old = json.load(open(path)) if os.path.exists(path) else {}
    rows = sorted(stats.select("section", "ord", "key", "value").collect())  # some dozens of numbers a sample
    new: dict[str, list] = {}
    for section, _, key, value in rows:
        new.setdefault(section, []).append([key, int(value) if float(value).is_integer() else value])
    old.update(new)
    with open(path, "w") as f:
        json.dump(old, f)
    return old


def read_stats(spark: SparkSession, path: str, sample: str = "") -> DataFrame:
    """Tidy (sample, section, ord, key, value, total) of a JSON file; keys of older files get today's names."""
    rows = []
    for section, pairs in json.load(open(path)).items():
        if not isinstance(pairs, list):
            continue
        for i, item in enumerate(pairs):
            if not (isinstance(item, list) and len(item) == 2 and isinstance(item[0], str)):
                continue
            key, v = item
            value, total = (v[0], v[1]) if isinstance(v, list) and len(v) == 2 else (v, None)
            if isinstance(value, (int, float)):
                rows.append((sample, section, i, RENAMED.get(key, key), float(value), None if total is None else float(total)))
    return spark.createDataFrame(rows, "sample string, section string, ord int, key string, value double, total double")


def log_lines(stats: dict) -> list[str]:
    return [f"{key} : {format_value(*(v if isinstance(v, list) else [v]))}" for pairs in stats.values() for key, v in pairs]


def table_cells(section: list, width: int = 70) -> list[tuple[str, str]]:
    """(name, value) cells of a report table, long names wrapped."""
    return [("\n".join(textwrap.wrap(str(k).replace("_", " "), width)), format_value(*v) if isinstance(v, list) else format_value(v)) for k, v in section]


def pie_values(section: list, names: list[str]) -> list[tuple[str, float]]:
    """(name, value) of the sectors that are over zero."""
    got = {RENAMED.get(k, k): (v[0] if isinstance(v, list) else v) for k, v in section}
    return [(n, float(got[n])) for n in names if got.get(n)]


def trimmed_histogram(values: list[float]) -> list[float]:
    """A histogram without the bins at its ends that are under a two-hundredth of the peak."""
    big = [i for i, v in enumerate(values) if v > max(values, default=0) / 200]
    return values[big[0] : big[-1] + 1] if big else []


def write_report(stats: dict, path: str) -> str:
    """A report as a PDF of tables where matplotlib is installed, else as text; returns the path."""
    try:
        from matplotlib.backends.backend_pdf import PdfPages
        from matplotlib.figure import Figure
    except ImportError:
        path = os.path.splitext(path)[0] + ".txt"
        with open(path, "w") as f:
            for name, section in stats.items():
                f.write(f"[{name}]\n" + "".join(f"{k}\t{v}\n" for k, v in table_cells(section)) + "\n")
        return path
    with PdfPages(path) as pdf:
        for name, section in stats.items():
            fig = Figure(figsize=(8, 10))
            ax = fig.add_subplot()
            ax.set_axis_off()
            ax.set_title(name)
            ax.table(cellText=table_cells(section), loc="upper center")
            pdf.savefig(fig)
    return path
