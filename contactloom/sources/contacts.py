"""Alignment (SAM) and contact (NCC) files: scans and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom.functions.ordered import file_lines, row_numbers, running_in_files
from contactloom.functions.plan import written

NCC = ("chr_a", "start_a", "end_a", "f_start_a", "f_end_a", "strand_a", "chr_b", "start_b", "end_b", "f_start_b", "f_end_b", "strand_b", "ambig", "pair_id", "swap_pair")
TEXT = ("chr_a", "strand_a", "chr_b", "strand_b", "ambig")


def read_sam(spark: SparkSession, paths: str | list[str], end: int, genome: int = 0) -> DataFrame:
    """(read_no, end, genome, flag, contig, pos, seq, qual, as_score, md, header) of all alignments; header lines are
    skipped. read_no is the number that the read's name begins with."""
    f = F.split("value", "\t")
    rows = spark.read.text(paths).filter(~F.startswith("value", F.lit("@"))).filter("length(value) > 0").select("value", f.alias("f"))
    g = lambda i: F.get("f", F.lit(i))
    return rows.select(
        F.regexp_extract(g(0), r"^(\d+)", 1).cast("long").alias("read_no"),
        F.lit(end).alias("end"),
        F.lit(genome).alias("genome"),
        g(1).cast("int").alias("flag"),
        g(2).alias("contig"),
        g(3).cast("long").alias("pos"),
        g(9).alias("seq"),
        g(10).alias("qual"),
        F.expr(r"try_cast(regexp_extract(value, '\\sAS:i:(\\S+)', 1) as bigint)").alias("as_score"),
        F.regexp_extract("value", r"\sMD:Z:(\S+)", 1).alias("md"),
        g(0).alias("header"),
    )


def read_ncc(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Contacts of NCC files with ambig_size, active, and k (the row's place in its group).

    The ambiguity column is size.flag on a group's first row and 0.flag on others; without a dot it is the number of
    the group, all rows active.
    """
    schema = ", ".join(f"{c} {'string' if c in TEXT else 'long'}" for c in NCC)
    df = spark.read.option("sep", " ").schema(schema).csv(paths)
    dotted = F.contains("ambig", F.lit("."))
    group = Window.partitionBy("pair_id")
    marker = F.when(dotted, F.substring_index("ambig", ".", 1).cast("int"))
    df = df.withColumn("marker", marker).withColumn("active", ~dotted | ~F.endswith("ambig", F.lit(".0")))
    order = group.orderBy(F.col("marker").desc(), *[c for c in NCC if c != "ambig"])
    return df.withColumn("ambig_size", F.count("*").over(group).cast("int")).withColumn("k", (F.row_number().over(order) - 1).cast("long")).drop("ambig")


def read_ncc_groups(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Contacts of NCC files by the running number of their group, for files without read numbers (13 columns) as well as with
    them: (line_no, group_no, the first twelve columns, marker, active). A group begins where the ambiguity column is above
    zero and goes on up to the next such line; files of a folder follow each other. Numbers begin with 1, lines with 0;
    lines before the first group have group 0.

    The numbers are running sums over splits: lines are not shuffled, and no task has more than its split.
    """
    f = F.split("value", " ")
    marker = F.expr("try_cast(substring_index(get(split(value, ' '), 12), '.', 1) as int)")
    lines = running_in_files(file_lines(spark.read.text(paths)), {"group_no": marker > 0, "line_no": F.lit(1)}, joined=True)
    kind = lambda c: "string" if c in TEXT else "long"
    sides = [F.get(f, F.lit(i)).cast(kind(c)).alias(c) for i, c in enumerate(NCC[:12])]
    code = F.get(f, F.lit(12))
    return lines.select((F.col("line_no") - 1).alias("line_no"), "group_no", *sides, marker.alias("marker"), (~F.contains(code, F.lit(".")) | ~F.endswith(code, F.lit(".0"))).alias("active"))


def ncc_text(contacts: DataFrame) -> DataFrame:
    """One line a contact, the group's size on its first row; for write.text."""
    size = F.when(F.col("k") == 0, F.col("ambig_size")).otherwise(0)
    code = F.concat(size.cast("string"), F.when(F.col("active"), ".1").otherwise(".0"))
    return contacts.select(F.concat_ws(" ", *[(code if c == "ambig" else F.col(c)).cast("string") for c in NCC]).alias("value"))


def write_ncc(contacts: DataFrame, path: str, compressed: bool = False) -> None:
    """Text files sorted by group inside each file."""
    rows = contacts.sortWithinPartitions("pair_id", "k")
    ncc_text(rows).write.option("compression", "gzip" if compressed else "none").text(path)


def sam_pairs(contacts: DataFrame, alignments: DataFrame) -> DataFrame:
    """(read_no, first, value): two SAM lines for each contact's read, mates marked and pointing at each other.

    alignments are those of read_sam for both ends; the best one of each end is taken.
    """
    ids = contacts.groupBy(F.col("pair_id").alias("read_no")).agg(F.max("swap_pair").alias("swap"))
    # one aggregation by read, which begins where a file's lines are read: what is not the best never moves
    order = F.struct(F.col("as_score").isNull(), F.bitwise_not("as_score"), "contig", "pos")
    rest = ("flag", "contig", "pos", "seq", "qual", "header")
    best = [F.min_by(F.struct(*rest), F.when(F.col("end") == e, order)).alias(f"_{e}") for e in (1, 2)]
    both = alignments.groupBy("read_no").agg(*best).filter("_1 is not null and _2 is not null")
    df = ids.join(both.select("read_no", *[F.col(f"_{e}.{c}").alias(f"{c}_{e}") for e in (1, 2) for c in rest]), "read_no")

    def line(x: int, y: int):
        unmapped = lambda e: F.col(f"flag_{e}").bitwiseAND(4) != 0
        first = F.when((F.col("swap") == 1) == F.lit(x == 2), 0x40).otherwise(0x80)
        flag = F.when(unmapped(x) | unmapped(y), 0).otherwise(
            F.col(f"flag_{x}").bitwiseOR(3).bitwiseOR(F.when(F.col(f"flag_{y}").bitwiseAND(16) != 0, 0x20).otherwise(0)).bitwiseOR(first)
        )
        mate = F.when(F.col(f"contig_{x}") == F.col(f"contig_{y}"), "=").otherwise(F.col(f"contig_{y}"))
        cols = [F.col(f"header_{x}"), flag.cast("string"), F.col(f"contig_{x}"), F.col(f"pos_{x}").cast("string"), F.lit("255"), F.concat(F.length(f"seq_{x}").cast("string"), F.lit("M")), mate, F.col(f"pos_{y}").cast("string"), F.lit("0"), F.col(f"seq_{x}"), F.col(f"qual_{x}")]
        return F.struct(first.alias("first"), F.concat_ws("\t", *cols).alias("value"))

    return df.select("read_no", F.explode(F.array(line(1, 2), line(2, 1))).alias("x")).select("read_no", "x.first", "x.value")


def sam_header(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(line_no, value) of the @ lines that stand before the first alignment of a file; over a folder's parts, in order."""
    head = F.startswith("value", F.lit("@"))
    lines = file_lines(spark.read.text(paths)).withColumn("_at", F.struct("path", "_block", "_line"))
    first = lines.filter(~head).agg(F.min("_at").alias("_body"))
    before = lines.filter(head).crossJoin(F.broadcast(first)).filter("_body is null or _at < _body")  # one row
    return row_numbers(written("header", before.select("path", "_block", "_line", "value")), ["path", "_block", "_line"], "line_no").select("line_no", "value")


def write_sam(contacts: DataFrame, alignments: DataFrame, path: str, header: DataFrame | None = None, program: str | None = None) -> None:
    """SAM in text parts that make up one file when read or put together in order: first the header lines (line_no, value) and
    an @PG line for `program`, then the body by read number, the first mate first. Range partitions sort it; no part has
    more than its range."""
    body = sam_pairs(contacts, alignments).select(F.lit(1).alias("_k"), F.col("read_no").alias("_n"), F.col("first").cast("long").alias("_m"), "value")
    if header is not None:
        body = header.select(F.lit(-1).alias("_k"), F.col("line_no").alias("_n"), F.lit(0).cast("long").alias("_m"), "value").unionByName(body)
    if program is not None:
        line = contacts.sparkSession.range(1).select(F.lit(0).alias("_k"), F.col("id").alias("_n"), F.lit(0).cast("long").alias("_m"), F.lit(f"@PG\tID:{program}").alias("value"))
        body = body.unionByName(line)
    body.orderBy("_k", "_n", "_m").select("value").write.text(path)
