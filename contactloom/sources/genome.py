"""Genome files: FASTA, chromosome names, homologs, restriction fragments, regions, contig naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom.functions.ordered import file_lines, running_in_files
from contactloom.functions.plan import broadcast_if_small, written


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(contig, seq): first word of each header, and its lines joined and upper-cased. Only a > that begins a line is a
    header; lines before the first one belong to no contig."""
    rows = spark.read.option("lineSep", "\n>").text(paths).select(F.regexp_replace("value", "\r", "").alias("value"), F.monotonically_increasing_id().alias("_id"), F.col("_metadata.file_block_start").alias("_at"))
    # the separator takes the > of all entries but one that begins the file
    first = F.startswith("value", F.lit(">"))
    head = F.split("value", "\n", 2)
    name = F.regexp_extract(F.regexp_replace(head[0], "^>", ""), r"^\s*(\S+)", 1)
    start = (F.col("_at") == 0) & (F.col("_id").bitwiseAND((1 << 33) - 1) == 0)
    got = rows.filter(~start | first)
    return got.select(name.alias("contig"), F.upper(F.regexp_replace(F.coalesce(F.get(head, F.lit(1)), F.lit("")), r"\s+", "")).alias("seq")).filter("contig <> ''")


#: Bases of a contig in one row.
BLOCK = 1 << 20


def read_fasta_blocks(spark: SparkSession, paths: str | list[str], size: int = BLOCK, overlap: int = 0) -> DataFrame:
    """(contig, block, start, bases, seq): the entries in blocks of `size` bases, upper-cased; seq (binary) runs on for `overlap`
    bases more where the contig does, bases are the block's own ones.

    Lines get their entry and their place in it by running sums over the splits of a file, so no contig is ever one
    value and no task reads a contig. Only a > that begins a line is a header; lines before the first one belong to no
    contig; an entry without bases has no block.
    """
    text = F.regexp_replace("value", r"\s+", "")
    head = F.startswith("value", F.lit(">"))
    lines = file_lines(spark.read.text(paths))
    placed = running_in_files(lines, {"_entry": head, "_bases": F.when(head, 0).otherwise(F.length(text))})
    name = F.regexp_extract("value", r"^>\s*(\S+)", 1)
    heads = placed.filter(head).select("path", "_entry", F.col("_bases").alias("_skip"), name.alias("contig")).filter("contig <> ''")
    rows = placed.filter(~head).select("path", "_entry", "_bases", F.upper(text).cast("binary").alias("_seq")).filter("length(_seq) > 0")
    rows = rows.join(broadcast_if_small(heads), ["path", "_entry"])  # a row a contig
    at = F.col("_bases") - F.col("_skip") - F.length("_seq")
    rows = rows.select("path", "_entry", "contig", at.alias("_at"), "_seq")
    return _blocks(rows, ["path", "_entry", "contig"], size, overlap).drop("path", "_entry")


def blocks_of(contigs: DataFrame, size: int = BLOCK, overlap: int = 0, name: str = "contig", seq: str = "seq") -> DataFrame:
    """The blocks of contigs that are values: (contig, block, start, bases, seq) as of read_fasta_blocks."""
    whole = contigs.select(F.col(name).alias("contig"), F.col(seq).cast("binary").alias("_seq")).filter("length(_seq) > 0")
    n = F.ceil(F.length("_seq") / size).cast("int")
    part = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.cast("long").alias("block"), F.substring("_seq", i * size + 1, F.lit(size + overlap)).alias("seq")))
    rows = whole.select("contig", F.explode(part).alias("x")).select("contig", "x.block", (F.col("x.block") * size).alias("start"), "x.seq")
    return rows.select("contig", "block", "start", F.least(F.length("seq"), F.lit(size)).cast("long").alias("bases"), "seq")


def _blocks(rows: DataFrame, by: list[str], size: int, overlap: int) -> DataFrame:
    """Stretches (by, _at, _seq) put together to blocks; a stretch goes to each block that it meets."""
    end = F.col("_at") + F.length("_seq")
    first, last = F.greatest(F.floor((F.col("_at") - overlap) / size), F.lit(0)), F.floor((end - 1) / size)
    rows = rows.withColumn("block", F.explode(F.sequence(first, last)))
    low, high = F.greatest(F.col("_at"), F.col("block") * size), F.least(end, (F.col("block") + 1) * size + overlap)
    piece = F.substring("_seq", (low - F.col("_at") + 1).cast("int"), (high - low).cast("int"))
    pieces = F.sort_array(F.collect_list(F.struct(low.alias("at"), piece.alias("seq"))))
    joined = F.array_join(F.transform(pieces, lambda x: x["seq"].cast("string")), "").cast("binary")
    got = rows.groupBy(*by, "block").agg(joined.alias("seq"))
    return got.select(*by, "block", (F.col("block") * size).alias("start"), F.least(F.length("seq"), F.lit(size)).cast("long").alias("bases"), "seq")


def read_names(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(contig, chr) from lines of two words, # comments aside; raises where either is given twice."""
    rows = spark.read.text(paths).select(F.split(F.trim(F.regexp_replace("value", "#.*", "")), r"\s+").alias("w")).filter("size(w) >= 2")
    names = rows.select(F.col("w")[0].alias("contig"), F.col("w")[1].alias("chr"))
    for c in ("contig", "chr"):
        twice = [r[0] for r in names.groupBy(c).count().filter("count > 1").limit(5).collect()]
        if twice:
            raise ValueError(f"{c} given twice: {twice}")
    return names


def homologs(names_1: DataFrame, names_2: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names, partners) of a hybrid genome: chromosomes named in both get .a and .b, and are each other's partner."""
    shared = names_1.select("chr").intersect(names_2.select("chr")).withColumn("_both", F.lit(True))
    tagged = []
    for names, tag in ((names_1, "a"), (names_2, "b")):
        df = names.join(shared, "chr", "left")
        tagged.append(df.select("contig", F.when(F.col("_both"), F.concat("chr", F.lit("." + tag))).otherwise(F.col("chr")).alias("chr"), F.lit(tag).alias("genome")))
    a = shared.select(F.concat("chr", F.lit(".a")).alias("chr"), F.concat("chr", F.lit(".b")).alias("partner"))
    return tagged[0].unionByName(tagged[1]), a.unionByName(a.select(F.col("partner").alias("chr"), F.col("chr").alias("partner")))


def rename(rows: DataFrame, names: DataFrame, column: str = "chr") -> DataFrame:
    """rows with contig names in `column` turned to chromosome names where there are any."""
    n = names.select(F.col("contig").alias("_k"), F.col("chr").alias("_v"))
    df = rows.join(n, F.col(column) == F.col("_k"), "left")
    return df.select(*[F.coalesce("_v", column).alias(column) if c == column else F.col(c) for c in rows.columns])


def write_fragments(frags: DataFrame, path: str, enzyme: str) -> None:
    frags.withColumn("enzyme", F.lit(enzyme)).write.mode("append").partitionBy("enzyme").parquet(path)


def read_fragments(spark: SparkSession, path: str, enzyme: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("enzyme") == enzyme).drop("enzyme")


def fragments_text(frags: DataFrame) -> DataFrame:
    """Tab-separated values in the exchange layout, mappability 1."""
    cols = [F.col("chr"), F.col("chr"), F.col("frag_start").cast("string"), F.col("frag_end").cast("string"), F.lit("1")]
    return frags.select(F.concat_ws("\t", *cols).alias("value"))


def read_fragments_text(spark: SparkSession, path: str) -> DataFrame:
    """(chr, contig, frag_idx, frag_start, frag_end, mappability) from the exchange layout, with or without header lines.

    A header is a line whose third field is no number."""
    text = spark.read.option("sep", "\t").schema("Source string, Contig string, _s string, _e string, Mappability int").csv(path)
    number = lambda c, name: F.expr(f"try_cast({c} as bigint)").alias(name)
    df = text.select("Source", "Contig", number("_s", "Frag_Start"), number("_e", "Frag_End"), "Mappability").filter("Frag_Start is not null")
    dup = df.groupBy("Source").agg(F.countDistinct("Contig").alias("n")).filter("n > 1").limit(1).count()
    if dup:
        raise ValueError("one chromosome name has several contigs")
    idx = F.row_number().over(Window.partitionBy("Source").orderBy("Frag_Start")) - 1
    return df.select(F.col("Source").alias("chr"), F.col("Contig").alias("contig"), idx.cast("long").alias("frag_idx"), F.col("Frag_Start").alias("frag_start"), F.col("Frag_End").alias("frag_end"), F.col("Mappability").alias("mappability"))


#: Bases of the smallest bin, and how many bins of one level make one of the next.
SMALLEST, FACTOR, LEVELS = 1 << 14, 8, 8


def bin_of(pos: Column, level: int | Column) -> Column:
    """The bin of a level that holds a position; the highest level has one bin."""
    level = F.lit(level)
    size = F.lit(SMALLEST) * F.pow(F.lit(FACTOR), level).cast("long")
    return F.when(level == LEVELS, F.lit(0)).otherwise(F.floor(pos / size)).cast("long")


def regions(spark: SparkSession, path: str) -> DataFrame:
    """(contig, start, end, level, bin): three-column regions, each in the smallest bin that holds it.

    Bins of level k have SMALLEST * FACTOR ** k bases, so a region is one row whatever its length, and a long one that
    holds many short ones costs no more than they do.
    """
    w = F.split(F.trim("value"), r"\s+")
    df = spark.read.text(path).filter("not startswith(value, '#')").select(w.alias("w")).filter("size(w) >= 3")
    df = df.select(F.col("w")[0].alias("contig"), F.col("w")[1].cast("long").alias("start"), F.col("w")[2].cast("long").alias("end"))
    level = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        level = F.when(bin_of(F.col("start"), k) == bin_of(F.col("end"), k), k).otherwise(level)
    return df.withColumn("level", level).withColumn("bin", bin_of(F.col("start"), F.col("level")))


def in_regions(rows: DataFrame, marked: DataFrame, chr_col: str, pos_col: str) -> DataFrame:
    """rows with `in_region`: whether the position lies in one of the regions (of `regions`).

    A position asks its bin at each level that regions have; a bin's regions come as one list, so no row multiplies. A
    list holds what lies in a smallest bin, or crosses a border between bins of the level below: long regions do not
    gather in short bins. A null position lies in none.
    """
    lists = written("regions", marked.groupBy("contig", "level", "bin").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_r")))
    levels = sorted(r.level for r in lists.select("level").distinct().collect())  # at most LEVELS + 1
    df, inside = rows, F.lit(False)
    for k in levels:
        mine = lists.filter(F.col("level") == k).select(F.col("contig").alias(f"_c{k}"), F.col("bin").alias(f"_b{k}"), F.col("_r").alias(f"_r{k}"))
        df = df.join(broadcast_if_small(mine), (F.col(chr_col) == F.col(f"_c{k}")) & (bin_of(F.col(pos_col), k) == F.col(f"_b{k}")), "left")
        inside = inside | F.coalesce(F.exists(f"_r{k}", lambda r: (F.col(pos_col) >= r["start"]) & (F.col(pos_col) <= r["end"])), F.lit(False))
    return df.select(*rows.columns, inside.alias("in_region"))


def mappability(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(source, contig, starts, size): sets of region starts by source, and the size of a region."""
    out = None
    for source, path in paths.items():
        one = regions(spark, path).select("contig", "start", "end").distinct().withColumn("source", F.lit(source))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("source", "contig").agg(F.sort_array(F.collect_set("start")).alias("starts"), F.min(F.col("end") - F.col("start")).alias("size"))


def contig_sizes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(contig, header, size) of FASTA entries, counted over lines, so that no sequence is held as one value. Lines learn their
    entry from running counts of headers; sizes are summed before the shuffle."""
    new = F.startswith("value", F.lit(">"))
    df = running_in_files(file_lines(spark.read.text(paths)), {"_entry": new}).filter("_entry > 0")
    got = df.groupBy("path", "_entry").agg(F.max(F.when(new, F.substring("value", F.lit(2), F.length("value")))).alias("header"), F.sum(F.when(~new, F.length(F.trim("value"))).otherwise(0)).alias("size"))
    return got.select(F.regexp_extract("header", r"^\s*(\S+)", 1).alias("contig"), "header", "size")


def name_contigs(contigs: DataFrame, metadata: DataFrame, min_kb: int = 100) -> DataFrame:
    """(contig, chr) for contigs over min_kb, from metadata (accession, chromosome, organelle, unlocalized).

    The table stands in for a lookup over the network. Organelles are chrMt or chrPl, unlocalised contigs are numbered
    within their chromosome, unknown ones keep their accession.
    """
    acc = F.regexp_extract("contig", r"^(?:gi\|[^|]*\|[^|]*\|)?([^|\s]+)", 1)
    df = contigs.filter(F.col("size") > min_kb * 1000).withColumn("accession", acc).join(metadata, "accession", "left")
    organelle = F.lower("organelle")
    name = (
        F.when(F.startswith("accession", F.lit("scaffold")), F.col("accession"))
        .when(organelle.contains("mitochond"), "chrMt")
        .when(organelle.contains("plast"), "chrPl")
        .when(organelle != "", "organelle")
        .when(F.col("chromosome").isNotNull() & (F.col("chromosome") != ""), F.concat(F.lit("chr"), "chromosome"))
        .otherwise(F.col("accession"))
    )
    df = df.withColumn("chr", name).withColumn("_u", F.coalesce("unlocalized", F.lit(False)))
    k = F.row_number().over(Window.partitionBy("chr", "_u").orderBy("contig"))
    return df.select("contig", F.when(F.col("_u"), F.concat("chr", F.lit("_unloc_"), k.cast("string"))).otherwise(F.col("chr")).alias("chr"))

