"""Secret scans: pattern matches, and sliding-window entropy over candidate strings.

Everything is row-local and built from SQL functions. For each pattern the text is cut once into matches
(`regexp_extract_all`) and gaps (`split`); running lengths give code-point positions. A candidate (a long run of the
characters of a class) is walked once by `aggregate`, whose state holds the counts of the window's characters and the
sum of c*log2(c): each step adds one character, removes one, and so knows the window's Shannon entropy. Windows at
or above the class's threshold merge into spans, but for those that overlap a text on the allow-list: candidates are
walked in the pieces between such texts.

Edge cases: a null text counts as empty; an empty one has no spans; equal rows give equal results; other columns are
ignored by `scan`'s result unless named in `keep`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int>"
#: Matches whose spans gather in one array.
CHUNK = 64

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"


@dataclass(frozen=True)
class EntropyClass:
    """Candidates of one character class: runs matching `pattern` (a class of characters), at least `window` long."""

    kind: str
    chars: str
    alphabet: str
    window: int
    bits: float
    needs: tuple[str, ...] = ()


CLASSES = (
    EntropyClass("entropy_hex", "[0-9A-Fa-f]", "0123456789abcdef", 20, 3.0, ("[0-9]", "[A-Fa-f]")),
    EntropyClass(
        "entropy_base64",
        "[A-Za-z0-9+/_=-]",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        24,
        3.9,
        ("[0-9]", "[A-Z]", "[a-z]"),
    ),
    # base32 seeds and base36 keys: one case and digits
    EntropyClass("entropy_upper", "[A-Z0-9]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 3.25, ("[0-9]", "[A-Z]")),
    EntropyClass("entropy_lower", "[a-z0-9]", "abcdefghijklmnopqrstuvwxyz0123456789", 20, 3.5, ("[0-9]", "[a-z]")),
)

#: Known not to be secrets: placeholders, counting strings, UUID-like dashes, runs of one character.
ALLOW = (
    r"(?i)example|placeholder|changeme|dummy",
    r"(?i)0123456789|abcdefghijkl",
    r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-fA-F])",
    r"(?<same>.)\k<same>{7,}",
)


def _no_spans() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def _place(kind: str, gaps: Column, found: Column, good) -> Column:
    """Spans of the matches for which good(index) holds, from the alternation gap, match, gap, ..."""
    # an array is copied whenever it grows, so spans gather in short ones
    none = F.expr(f"cast(array() as array<array<{SPAN}>>)")

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(gaps, i))
        end = start + F.length(F.get(found, i))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(good(i), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def chunk(acc: Column, at: Column) -> Column:
        here = F.aggregate(F.sequence(at, F.least(at + CHUNK, F.size(found)) - 1), F.struct(acc["at"].alias("at"), _no_spans().alias("out")), step)
        return F.transform(F.array(here), lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")))[0]

    chunks = F.sequence(F.lit(0), F.size(found) - 1, F.lit(CHUNK))
    placed = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), none.alias("out")), chunk, lambda acc: F.flatten(acc["out"]))
    return F.when(F.size(found) > 0, placed).otherwise(_no_spans())


def _pieces(text: Column, known: str) -> Column:
    """Stretches of the text between matches of known, as structs of a and b."""
    whole = F.array(F.struct(F.lit(0).alias("a"), F.length(text).alias("b")))
    if not known:
        return whole

    def cut(x: Column) -> Column:
        gaps, found = x["gaps"], x["found"]
        zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<a:int,b:int>>)").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            end = acc["at"] + F.length(F.get(gaps, i))
            after = end + F.coalesce(F.length(F.get(found, i)), F.lit(0))
            return F.struct(after.alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("a"), end.alias("b")))).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(gaps) - 1), zero, step, lambda acc: acc["out"])

    both = F.struct(F.split(text, known, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(known), F.lit(0)).alias("found"))
    return F.when(text.rlike(known), F.transform(F.array(both), cut)[0]).otherwise(whole)


def _windows(kind: EntropyClass, text: Column, base: Column) -> Column:
    """Merged spans (relative to base) of the windows of one candidate whose entropy is high enough."""
    w = kind.window
    clog = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 2)])
    folded = F.lower(text) if kind.alphabet == kind.alphabet.lower() else text
    codes = F.transform(F.split(folded, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
    most = (math.log2(w) - kind.bits) * w + 1e-9  # entropy >= bits is the same as the sum of c*log2(c) <= most
    zero = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("n"),
        F.lit(0.0).alias("s"),
        F.expr("cast(array() as array<struct<a:int,b:int>>)").alias("out"),
    )

    def walk(chars: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            new, old = F.get(chars, i), F.get(chars, F.greatest(i - w, F.lit(0)))
            full = i >= w
            c_new = F.get(acc["n"], new)
            c_old = F.get(acc["n"], old) + F.when(old == new, 1).otherwise(0)
            s = (
                acc["s"]
                + F.get(clog, c_new + 1)
                - F.get(clog, c_new)
                + F.when(full, F.get(clog, c_old - 1) - F.get(clog, c_old)).otherwise(0.0)
            )
            n = F.transform(
                acc["n"], lambda c, j: c + F.when(j == new, 1).otherwise(0) - F.when(full & (j == old), 1).otherwise(0)
            )
            a, b = i - (w - 1), i + 1
            last = F.try_element_at(acc["out"], F.lit(-1))
            merged = F.when(
                last["b"] >= a,
                F.concat(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(F.struct(last["a"].alias("a"), b.alias("b")))),
            ).otherwise(F.concat(acc["out"], F.array(F.struct(a.alias("a"), b.alias("b")))))
            return F.transform(
                F.array(s),
                lambda v: F.struct(
                    n.alias("n"), v.alias("s"), F.when((i >= w - 1) & (v <= most), merged).otherwise(acc["out"]).alias("out")
                ),
            )[0]

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), zero, step, lambda acc: acc["out"])

    spans = F.transform(F.array(codes), walk)[0]
    return F.transform(
        spans,
        lambda x: F.struct(F.lit(kind.kind).alias("kind"), (base + x["a"]).alias("start"), (base + x["b"]).alias("end")),
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    classes: Sequence[EntropyClass] = CLASSES,
    allow: Sequence[str] = ALLOW,
) -> DataFrame:
    """docs[keep] with `base` (assign, access and hex spans) and `added` (entropy spans), each sorted.

    A span is (kind, start, end) in code points, end exclusive. Base spans are the leftmost matches of each kind that
    do not overlap; assign matches whose value has under 12 characters, access keys under 18 and hex runs under 16
    are left out.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    known = "|".join(f"(?:{x})" for x in allow)
    kinds = {"assign": ASSIGN, "access": ACCESS, "hex": HEX} | {c.kind: f"{c.chars}{{{c.window},}}" for c in classes}
    found = docs.select(*keep, t.alias("_t")).select(
        *keep, "_t", *[F.regexp_extract_all("_t", F.lit(p), F.lit(0)).alias(f"_m_{k}") for k, p in kinds.items()]
    )
    cut = found.select(
        "*",
        F.when(F.size("_m_assign") > 0, F.regexp_extract_all("_t", F.lit(ASSIGN), F.lit(2))).alias("_v"),
        *[F.when(F.size(f"_m_{k}") > 0, F.split("_t", p, -1)).alias(f"_g_{k}") for k, p in kinds.items()],
    )
    good = {
        "assign": lambda i: F.length(F.get(F.col("_v"), i)) >= 12,
        "access": lambda i: F.length(F.get(F.col("_m_access"), i)) >= 18,
        "hex": lambda i: F.lit(True),
    }
    for c in classes:
        col = F.col(f"_m_{c.kind}")

        def fits(i: Column, c=c, col=col) -> Column:
            s = F.get(col, i)
            ok = F.lit(True)
            for need in c.needs:
                ok = ok & s.rlike(need)
            return ok

        good[c.kind] = fits
    spans = cut.select(*keep, "_t", *[_place(k, F.col(f"_g_{k}"), F.col(f"_m_{k}"), good[k]).alias(f"_s_{k}") for k in kinds])
    order = {k: i for i, k in enumerate(kinds)}

    def ranked(parts: list[Column]) -> Column:
        if not parts:
            return _no_spans()
        rank = F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))])
        keyed = F.transform(
            F.concat(*parts), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("r"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
        return F.transform(
            F.array_sort(keyed),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )

    def windows(c: EntropyClass) -> Column:
        part = lambda a, b: F.substring(F.col("_t"), a + 1, b - a)

        def walked(s: Column) -> Column:
            long = F.filter(_pieces(part(s["start"], s["end"]), known), lambda p: p["b"] - p["a"] >= c.window)
            at = lambda p: s["start"] + p["a"]
            return F.flatten(F.transform(long, lambda p: _windows(c, part(at(p), s["start"] + p["b"]), at(p))))

        return F.when(F.size(f"_s_{c.kind}") > 0, F.flatten(F.transform(F.col(f"_s_{c.kind}"), walked))).otherwise(_no_spans())

    base = [F.col("_s_assign"), F.col("_s_access"), F.col("_s_hex")]
    added = [windows(c) for c in classes]
    out = spans.select(*keep, *[x.alias(f"_b{i}") for i, x in enumerate(base)], *[x.alias(f"_a{i}") for i, x in enumerate(added)])
    b, a = [F.col(f"_b{i}") for i in range(len(base))], [F.col(f"_a{i}") for i in range(len(added))]
    none = _no_spans()
    return out.select(
        *keep,
        F.when(sum((F.size(x) for x in b), F.lit(0)) > 0, ranked(b)).otherwise(none).alias("base"),
        F.when(sum((F.size(x) for x in a), F.lit(0)) > 0, ranked(a)).otherwise(none).alias("added"),
        F.when(sum((F.size(x) for x in b + a), F.lit(0)) > 0, ranked(b + a)).otherwise(none).alias("spans"),
    )


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span of every kind in `text` replaced by one [SECRET]; all columns stay, in order."""
    names = docs.columns
    hidden = {c: f"_x{i}" for i, c in enumerate(names)}  # so that no column clashes with those of scan
    plain = docs.toDF(*hidden.values())
    got = scan(plain.withColumn("_text", F.col(hidden[text])), "_text", [*hidden.values(), "_text"])
    t = F.col("_text")
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit("[SECRET]"))
        # a span that begins inside the last one only lengthens it
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"),
        )

    masked = F.aggregate(
        F.col("spans"), zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(t, acc["at"] + 1, F.length(t)))
    )
    new = F.when(F.size("spans") > 0, masked).otherwise(F.col("_text"))
    return got.select(*[(new if c == text else F.col(hidden[c])).alias(c) for c in names])


def query(spark, sf_dir: str) -> DataFrame:
    """op1: all spans of every document, with counts and a digest of the base ones."""
    got = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return got.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
