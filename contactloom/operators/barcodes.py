"""Demultiplexing by barcodes: exact and near matches, splicing of paired reads, counts and reports.

Barcodes are matched once for every distinct one, not for every read; the match table is small by nature (distinct
barcodes of a run) and joins back on the barcode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.functions.ordered import row_numbers
from contactloom.functions.plan import broadcast_if_small, written

LEVELS = (1_000_000, 100_000, 10_000, 1_000, 100)


def hamming(a: Column, b: Column) -> Column:
    """Differing characters of two strings; the longer one's rest counts as different."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1)), F.lit(0), lambda s, x: s + x)


def neighbours(code: Column, mismatches: int) -> Column:
    """All strings over ACGTN within one substitution for each mismatch allowed; codes are short, so lists are too."""
    out = F.array(code)
    for _ in range(mismatches):
        out = F.array_distinct(
            F.flatten(
                F.transform(
                    out,
                    lambda s: F.flatten(
                        F.transform(
                            F.sequence(F.lit(1), F.length(s)),
                            lambda i: F.transform(F.array(*[F.lit(c) for c in "ACGTN"]), lambda c: F.concat(F.substring(s, F.lit(1), i - 1), c, F.substring(s, i + 1, F.length(s)))),
                        )
                    ),
                )
            )
        )
    return out


def segments(code: Column, mismatches: int) -> Column:
    """array<struct<length, at, part>>: mismatches + 1 pieces that make up the code. Codes of one length that differ in no more
    places than `mismatches` have one of them in common."""
    n = F.length(code)
    edge = lambda i: F.floor(n * i / (mismatches + 1)).cast("int")
    return F.array(*[F.struct(n.alias("length"), F.lit(i).alias("at"), F.substring(code, edge(i) + 1, edge(i + 1) - edge(i)).alias("part")) for i in range(mismatches + 1)])


def near_codes(observed: DataFrame, valid: DataFrame, mismatches: int) -> DataFrame:
    """(code, match, distance): all pairs of distinct codes of one length that differ in at most `mismatches` places.

    One mismatch: valid codes are spread to their few neighbours. More: codes are indexed by pieces, equality on one of which
    makes a candidate, which is then compared; the index grows with the codes and not with their neighbourhoods.
    """
    codes, known = observed.select("code").distinct(), valid.select(F.col("code").alias("match")).distinct()
    if mismatches < 2:
        near = known.select("match", F.explode(F.when(F.length("match") > 0, neighbours(F.col("match"), mismatches)).otherwise(F.array("match"))).alias("code"))
        return codes.join(broadcast_if_small(near), "code").withColumn("distance", hamming(F.col("code"), F.col("match")))
    piece = lambda df, c: df.select(c, F.explode(segments(F.col(c), mismatches)).alias("x")).select(c, "x.*")
    found = piece(codes, "code").join(broadcast_if_small(piece(known, "match")), ["length", "at", "part"])
    found = found.withColumn("distance", hamming(F.col("code"), F.col("match"))).filter(F.col("distance") <= mismatches)
    return found.select("code", "match", "distance").distinct()


def match_codes(observed: DataFrame, valid: DataFrame, mismatches: int = 0) -> DataFrame:
    """(code, match, distance) of distinct observed codes: an exact match, or the only valid code within `mismatches`."""
    found = near_codes(observed, valid, mismatches)
    best = found.groupBy("code").agg(F.count("*").alias("n"), F.min(F.struct("distance", "match")).alias("b"))
    return best.filter((F.col("n") == 1) | (F.col("b.distance") == 0)).select("code", F.col("b.match").alias("match"), F.col("b.distance").cast("long").alias("distance"))


def demultiplex(reads: DataFrame, valid: DataFrame, mismatches: int = 0, dual: bool = False, trim: bool = True) -> DataFrame:
    """reads (read_no, code or code_1 and code_2, seq.., qual..) with matched code(s), `sample`, and `valid`.

    valid has (code, sample), or (code_1, code_2, sample) for dual codes, whose two halves match independently.
    """
    if not dual:
        m = match_codes(reads, valid, mismatches)
        df = reads.join(broadcast_if_small(m), "code", "left")
        names = valid.select(F.col("code").alias("match"), "sample")
        return df.join(broadcast_if_small(names), "match", "left").withColumn("valid", F.col("match").isNotNull())
    df = reads
    for k in (1, 2):
        m = match_codes(reads.select(F.col(f"code_{k}").alias("code")), valid.select(F.col(f"code_{k}").alias("code")), mismatches)
        df = df.join(broadcast_if_small(m.select(F.col("code").alias(f"code_{k}"), F.col("match").alias(f"match_{k}"), F.col("distance").alias(f"distance_{k}"))), f"code_{k}", "left")
    names = valid.select(F.col("code_1").alias("match_1"), F.col("code_2").alias("match_2"), "sample")
    return df.join(broadcast_if_small(names), ["match_1", "match_2"], "left").withColumn("valid", F.col("match_1").isNotNull() & F.col("match_2").isNotNull())


def header_code(header: Column) -> Column:
    """The code at the end of an Illumina header, after the last colon."""
    return F.element_at(F.split(header, ":"), -1)


def count_codes(reads: DataFrame) -> DataFrame:
    """(code, n, percent, sample_rank): counts by falling (n, code)."""
    counts = reads.groupBy("code").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    ranked = counts.crossJoin(F.broadcast(total))  # one row
    return ranked.select("code", "n", F.round(100.0 * F.col("n") / F.col("total"), 6).alias("percent"))


def name_samples(counts: DataFrame, valid: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """counts with sample names; codes without one are sample_1, sample_2 .. by falling (n, code). Their numbers come from sorted
    ranges, so there may be as many as there are reads."""
    df = counts
    if valid is not None:
        df = df.join(broadcast_if_small(valid.select("code", "sample")), "code", "left")
    else:
        df = df.withColumn("sample", F.lit(None).cast("string"))
    df = written("codes", df)
    unnamed = row_numbers(df.filter("sample is null"), [F.col("n").desc(), F.col("code").desc()], "_k", 1, partitions)
    named = unnamed.select(*[F.concat(F.lit("sample_"), F.col("_k").cast("string")).alias(c) if c == "sample" else F.col(c) for c in df.columns])
    return df.filter("sample is not null").unionByName(named)


def level_counts(counts: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(level, n): how many codes have at least so many reads."""
    rows = counts.select(F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("level"), (F.col("n") >= k).cast("long").alias("has")) for k in levels])).alias("x"))
    return rows.groupBy(F.col("x.level").alias("level")).agg(F.sum("x.has").alias("n"))


def demux_stats(matched: DataFrame) -> DataFrame:
    """One row: reads, exact, imperfect, lost."""
    return matched.agg(
        F.count("*").alias("n_reads"), F.count_if("valid").alias("n_valid"), F.count_if(F.expr("valid and distance = 0")).alias("n_perfect"),
        F.count_if(F.expr("valid and distance > 0")).alias("n_imperfect"), F.count_if(F.expr("not valid")).alias("n_lost"),
    )


def demultiplex_simple(pairs: DataFrame, size: int = 3) -> tuple[DataFrame, DataFrame]:
    """(reads, stats) for mates (read_no, seq_1, qual_1, seq_2, qual_2) that start with the same code; the code and one
    more base are taken off."""
    df = pairs.withColumn("code", F.substring("seq_1", 1, size)).withColumn("_same", F.col("code") == F.substring("seq_2", 1, size))
    cut = lambda c: F.substring(c, F.lit(size + 2), F.length(c)).alias(c)
    reads = df.filter("_same").select("read_no", "code", *[cut(f"{c}_{k}") for k in (1, 2) for c in ("seq", "qual")])
    stats = df.agg(F.count("*").alias("n_pairs"), F.count_if("_same").alias("matched"), F.count_if(~F.col("_same")).alias("mismatched"), F.count_if(F.contains("code", F.lit("N"))).alias("with_n"))
    return reads, stats


def pair_by_number(a: DataFrame, b: DataFrame) -> DataFrame:
    """Mates (read_no, header_1, seq_1, qual_1, .._2) by position; the shorter file ends the pairing."""
    side = lambda d, k: d.select("read_no", *[F.col(c).alias(f"{c}_{k}") for c in ("header", "seq", "qual")])
    return side(a, 1).join(side(b, 2), "read_no")


def splice(a: DataFrame, b: DataFrame, check_ids: bool = True, keep_ids: bool = False) -> DataFrame:
    """(read_no, header, seq, plus, qual): the two mates as one read. With check_ids, headers that differ before their
    last space raise an error when the row is computed."""
    df = pair_by_number(a, b)
    name = lambda c: F.regexp_extract(c, r"^(.*?)(?: [^ ]*)?$", 1)
    header = F.col("header_1")
    if check_ids:
        header = F.when(name("header_1") == name("header_2"), header).otherwise(F.raise_error(F.concat(F.lit("reads differ: "), F.col("header_1"), F.lit(" and "), F.col("header_2"))).cast("string"))
    plus = F.concat(F.lit("+"), F.substring("header_1", F.lit(2), F.length("header_1"))) if keep_ids else F.lit("+")
    return df.select("read_no", header.alias("header"), F.concat("seq_1", "seq_2").alias("seq"), plus.alias("plus"), F.concat("qual_1", "qual_2").alias("qual"))


def demultiplex_cells(reads: DataFrame, tags: DataFrame) -> DataFrame:
    """reads whose header tag is in `tags` (tag, inner_a, inner_b, outer) with equal inner codes, with `cell`."""
    good = tags.filter("inner_a = inner_b").select("tag", F.concat_ws("_", "inner_a", "outer").alias("cell"))
    return reads.withColumn("tag", F.regexp_extract("header", r"([^:\s]+)\s*$", 1)).join(broadcast_if_small(good), "tag")
