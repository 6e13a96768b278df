"""Restriction sites: the `^`/`_` notation, recognition sequences, ligation junctions; at plan time for the sites of a run, and
as columns for tables of sites."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Common enzymes in the site notation.
ENZYMES = {
    "BglII": "A^GATC_T",
    "DpnII": "^GATC_",
    "HindIII": "A^AGCT_T",
    "MboI": "^GATC_",
    "AluI": "AG^CT",
}
#: Ordinal of quality zero.
QUALITY_ZERO = {"phred33": 33, "phred64": 64, "solexa": 64}
SOURCE_ALPHABET = set("^_GCATN")


class SiteError(ValueError):
    """A site, junction or adapter that can't be used."""


def check_site(site: str) -> str:
    """The site, upper-cased, if it is over ^_GCATN with one ^ and at most one _."""
    s = site.upper()
    if extra := set(s) - SOURCE_ALPHABET:
        raise SiteError(f"site {site!r} has characters {sorted(extra)}")
    if s.count("^") != 1 or s.count("_") > 1:
        raise SiteError(f"site {site!r} needs one ^ and at most one _")
    return s


def recognition(site: str) -> str:
    """The recognition sequence: the site without its cut marks."""
    return check_site(site).replace("^", "").replace("_", "")


def junction(site: str) -> str:
    """What two filled-in ends read after ligation. A blunt cut reads as the site itself."""
    s = check_site(site)
    if "_" not in s:
        return recognition(s)
    first, second = sorted((s.index("^"), s.index("_")))
    left, middle, right = s[:first], s[first + 1 : second], s[second + 1 :]
    return left + middle + middle + right


def site_regex(site: str) -> str:
    return recognition(site).replace("N", "[AGCT]")


def check_bases(seq: str, alphabet: str) -> str:
    s = seq.upper()
    if set(s) - set(alphabet):
        raise SiteError(f"{seq!r} is not over {alphabet}")
    return s


def check_junction(seq: str) -> str:
    return check_bases(seq, "AGCTN")


def check_adapters(seqs: Iterable[str]) -> list[str]:
    return [check_bases(s, "GCAT") for s in seqs]


def load_enzymes(path: str | Path | None = None, known: Mapping[str, str] = ENZYMES) -> dict[str, str]:
    """Known enzymes, overridden by a file of `name site` lines."""
    out = dict(known)
    if path is not None:
        for line in Path(path).read_text().splitlines():
            parts = line.split("#")[0].split()
            if len(parts) >= 2:
                out[parts[0]] = check_site(parts[1])
    return out


def parse_sizes(text: str) -> tuple[int, float]:
    """(least, greatest) of a size range such as 150-1500; one number means no upper bound."""
    sizes = sorted(int(x) for x in re.split(r"\D+", text) if x)
    if not sizes:
        raise SiteError(f"no size in {text!r}")
    return (sizes[0], 1e16) if len(sizes) == 1 else (sizes[0], sizes[-1])


def site_error(site: Column) -> Column:
    """What check_site would say of a column's sites, null where they are fit."""
    s = F.upper(site)
    count = lambda c: F.length(s) - F.length(F.replace(s, F.lit(c), F.lit("")))
    return F.when(~s.rlike(r"^[\^_GCATN]*$"), "characters").when((count("^") != 1) | (count("_") > 1), "marks")


def recognitions(site: Column) -> Column:
    return F.regexp_replace(F.upper(site), r"[\^_]", "")


def junctions(site: Column) -> Column:
    """As junction, of a column of fit sites."""
    s = F.upper(site)
    parts = F.split(s, r"[\^_]")
    left, middle, right = (F.get(parts, F.lit(i)) for i in range(3))
    return F.when(F.contains(s, F.lit("_")), F.concat(left, middle, middle, right)).otherwise(recognitions(site))


def site_patterns(site: Column) -> Column:
    return F.replace(recognitions(site), F.lit("N"), F.lit("[AGCT]"))


def bases_fit(seq: Column, alphabet: str) -> Column:
    """Whether a column's sequences are over an alphabet of letters, in either case."""
    return F.upper(seq).rlike(f"^[{alphabet}]*$")
