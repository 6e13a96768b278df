"""Registered queries of sources, sinks and options, with their SQL twins.

A source's query writes a derived table through the package's own sink to the shared folder, reads it back, and returns
what it has read; the twin is SQL for the derived table.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.functions import files, sites
from contactloom.functions.ordered import file_lines, running_in_files
from contactloom.functions.plan import new_path
from contactloom.operators import barcodes, classify, clip, contact_map, contact_stats, dedupe, digest, disambiguate, pairing
from contactloom.plans import queries as q
from contactloom.plans import views
from contactloom.plans.oracle import ORACLE as ORACLE_PLAIN
from contactloom.plans.oracle import AL, BC, CD, CO, FR, FR2, LOADED, NORMAL, PAIRS, POS, R, SCORES, T, V
from contactloom.sources import contacts as contact_files
from contactloom.sources import fastq, fastq_source, genome, stats_io

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def twin(sql: str):
    """Registers a query under its name, with its SQL twin."""

    def add(call):
        QUERIES[call.__name__] = call
        ORACLE[call.__name__] = sql
        return call

    return add


def _put(spark: SparkSession, lines: DataFrame, name: str, compression: str = "none") -> str:
    path = new_path(spark, name)
    lines.write.option("compression", compression).text(path)
    return path


def _reads(spark: SparkSession, d: str) -> DataFrame:
    return views.view(spark, d, views.READS, "orders").withColumn("header", F.concat(F.lit("@r"), F.col("read_no").cast("string")))


def _number(header: str = "header"):
    return F.regexp_extract(header, r"r(\d+)", 1).cast("long").alias("read_no")


@twin(f"SELECT read_no, seq, '+' AS plus, qual FROM ({R}) r")
def a2_fastq(spark, d):
    path = _put(spark, fastq.fastq_text(_reads(spark, d)), "fastq")
    return fastq_source.scan_fastq(spark, path, 1 << 20).select(_number(), "seq", "plus", "qual")


@twin(f"SELECT read_no, seq, '+' AS plus, qual FROM ({R}) r")
def a2_fastq_numbered(spark, d):
    path = _put(spark, fastq.fastq_text(_reads(spark, d)), "fastq")
    return fastq.read_fastq(spark, path).select(_number(), "seq", "plus", "qual")


@twin(f"SELECT read_no, length(seq) AS n FROM ({R}) r")
def a15_fastq_gzip(spark, d):
    path = _put(spark, fastq.fastq_text(_reads(spark, d)), "fastq", "gzip")
    return fastq.read_fastq(spark, path).select(_number(), F.length("seq").cast("long").alias("n"))


@twin(f"SELECT CASE WHEN read_no % 10 = 3 THEN 'r' || cast(read_no AS varchar) ELSE 'x' END AS value FROM ({R}) r WHERE read_no % 10 IN (3, 7)")
def a3_fastq_errors(spark, d):
    r = _reads(spark, d)
    head = F.when(F.col("read_no") % 10 == 3, F.concat(F.lit("r"), F.col("read_no").cast("string"))).otherwise(F.col("header"))
    plus = F.when(F.col("read_no") % 10 == 7, "x").otherwise("+")
    path = _put(spark, r.select(F.concat_ws("\n", head, "seq", plus, "qual").alias("value")), "fastq")
    return fastq.validate_fastq(fastq.numbered_lines(spark, path), head=1 << 40).select("value")


def _fasta(spark, d) -> str:
    """A FASTA file of all contigs, lines of 60 bases."""
    c = views.view(spark, d, views.CONTIGS["spark"], "documents")
    lines = F.regexp_replace("seq", "(.{60})", "$1\n")
    return _put(spark, c.select(F.concat(F.lit(">"), F.col("contig").cast("string"), F.lit(" a>b note\n"), lines).alias("value")), "fasta")


@twin(f"SELECT cast(contig AS varchar) AS contig, md5(upper(seq)) AS seq_md5, length(seq) AS size FROM ({CO}) c")
def a4_fasta(spark, d):
    return genome.read_fasta(spark, _fasta(spark, d)).select("contig", F.md5("seq").alias("seq_md5"), F.length("seq").cast("long").alias("size"))


@twin(f"""WITH c AS ({CO}), b AS (SELECT contig, seq, unnest(range(0, cast(ceil(length(seq) / 1000.0) AS bigint))) AS block FROM c WHERE length(seq) > 0)
 SELECT cast(contig AS varchar) AS contig, block, block * 1000 AS start, least(length(seq) - block * 1000, 1000) AS bases, md5(substr(seq, block * 1000 + 1, 1030)) AS seq_md5 FROM b""")
def a4_fasta_blocks(spark, d):
    blocks = genome.read_fasta_blocks(spark, _fasta(spark, d), 1000, 30)
    return blocks.select("contig", "block", "start", "bases", F.md5("seq").alias("seq_md5"))


@twin(ORACLE_PLAIN["d1_fragments"].replace("SELECT contig, idx AS frag_idx", "SELECT cast(contig AS varchar) AS contig, idx AS frag_idx"))
def d1_file_fragments(spark, d):
    return digest.fragments_in_blocks(genome.read_fasta_blocks(spark, _fasta(spark, d), q.SMALL, 3), "^GATC_")


def _sam_lines(a: DataFrame) -> DataFrame:
    """(end, value): a header line, of the first end's file, and a line an alignment."""
    s = lambda c: F.col(c).cast("string")
    cols = [F.format_string("%010d", "read_no"), s("flag"), "contig", s("pos"), F.lit("255"), F.lit("50M"), F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", F.concat(F.lit("AS:i:"), s("as_score")), F.concat(F.lit("MD:Z:"), "md")]
    return a.sparkSession.range(1).select(F.lit(1).alias("end"), F.lit("@HD\tVN:1.0").alias("value")).unionByName(a.select("end", F.concat_ws("\t", *cols).alias("value")))


def _sam(spark, d) -> str:
    return _put(spark, _sam_lines(q._alignments(spark, d)).select("value"), "sam")


def _sam_of_ends(spark, d) -> list[str]:
    """A SAM file of each end, packed."""
    path = new_path(spark, "sam")
    _sam_lines(q._alignments(spark, d)).write.partitionBy("end").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    return [f"{path}/end={e}" for e in (1, 2)]


def _sam_parts(spark, d, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Contacts, one of each read of the table, and the alignments of both ends' files."""
    ids = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("pair_id")).distinct()
    one, two = (contact_files.read_sam(spark, p, e) for e, p in enumerate(paths, 1))
    return ids.select("pair_id", (F.col("pair_id") % 2).alias("swap_pair")), one.unionByName(two)


@twin(f"SELECT read_no, flag, contig, pos, seq, qual, as_score, md FROM ({AL}) a")
def a5_sam(spark, d):
    return contact_files.read_sam(spark, _sam(spark, d), 1).select("read_no", "flag", "contig", "pos", "seq", "qual", "as_score", "md")


NCC_SIDES = "chr_a, start_a, end_a, start_a AS f_start_a, end_a AS f_end_a, strand_a, chr_b, start_b, end_b, start_b AS f_start_b, end_b AS f_end_b, strand_b"
NCC_ROWS = f"SELECT pair_id, {NCC_SIDES}, pair_id % 2 AS swap_pair, cast(ambig_size AS int) AS ambig_size, line_no % 4 <> 0 AS active FROM ({V}) v"


def _ncc(spark, d) -> DataFrame:
    v = views.contacts(spark, d)
    k = F.row_number().over(q.Window.partitionBy("pair_id").orderBy("line_no")) - 1
    rows = v.withColumn("k", k.cast("long")).selectExpr("pair_id", *NCC_SIDES.split(", "), "pair_id % 2 AS swap_pair", "ambig_size", "line_no % 4 <> 0 AS active", "k")
    return rows


@twin(NCC_ROWS)
def a6_ncc(spark, d):
    path = new_path(spark, "ncc")
    contact_files.write_ncc(_ncc(spark, d), path, compressed=True)
    return contact_files.read_ncc(spark, path).select("pair_id", *[c for c in contact_files.NCC if c not in ("ambig", "pair_id")], "ambig_size", "active")


#: An order of a group's rows without ties that matter.
GROUP_ORDER = "line_no, start_a, start_b, chr_a, chr_b, strand_a, strand_b"


def _ncc_without_numbers(spark, d) -> str:
    """An NCC file of 13 columns, its groups one after another in parts that cut through groups."""
    v = views.contacts(spark, d)
    k = F.row_number().over(q.Window.partitionBy("pair_id").orderBy(*GROUP_ORDER.split(", "))) - 1
    rows = v.withColumn("k", k).selectExpr("pair_id", "k", *NCC_SIDES.split(", "), "concat(CASE WHEN k = 0 THEN ambig_size ELSE 0 END, CASE WHEN line_no % 4 <> 0 THEN '.1' ELSE '.0' END) AS code")
    lines = rows.repartitionByRange(7, "pair_id", "k").sortWithinPartitions("pair_id", "k")
    return _put(spark, lines.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in contact_files.NCC[:12]], "code").alias("value")), "ncc")


NUMBERED = f"""v AS ({V}), s AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY {GROUP_ORDER}) - 1 AS k FROM v),
 n AS (SELECT *, row_number() OVER (ORDER BY pair_id, k) - 1 AS ln, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) OVER (ORDER BY pair_id, k) AS g FROM s)"""


@twin(f"WITH {NUMBERED} SELECT ln AS line_no, cast(g AS bigint) AS group_no, chr_a, start_a, chr_b, start_b, cast(CASE WHEN k = 0 THEN ambig_size ELSE 0 END AS int) AS marker, n.line_no % 4 <> 0 AS active FROM n")
def h1_group_numbers(spark, d):
    return contact_files.read_ncc_groups(spark, _ncc_without_numbers(spark, d)).select("line_no", "group_no", "chr_a", "start_a", "chr_b", "start_b", "marker", "active")


@twin(f"""WITH {NUMBERED}, c AS (SELECT *, CASE WHEN chr_a <> chr_b THEN 2 WHEN abs(CASE WHEN strand_a = '+' THEN end_a ELSE start_a END - CASE WHEN strand_b = '+' THEN end_b ELSE start_b END) < 10000 THEN 0 ELSE 1 END AS code FROM n),
 gr AS (SELECT g, count(*) AS m, max(code) AS code FROM c GROUP BY g) SELECT count(*) AS total_contacts, count(*) FILTER (m > 1) AS ambig_contacts, cast(sum(m) AS bigint) AS total_pairs,
 round(coalesce(sum(m) FILTER (m > 1), 0) / greatest(count(*) FILTER (m > 1), 1), 6) AS mean_ambiguity, count(*) FILTER (code = 0) AS cis_near, count(*) FILTER (code = 1) AS cis_far, count(*) FILTER (code = 2) AS trans, count(*) FILTER (code = 3) AS homolog_trans FROM gr""")
def g5_numbered_stats(spark, d):
    groups = contact_files.read_ncc_groups(spark, _ncc_without_numbers(spark, d)).withColumnRenamed("group_no", "pair_id")
    return contact_stats.contact_stats(groups)


SAM_SQL = f"""WITH al AS ({AL}), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY read_no, "end" ORDER BY as_score DESC, contig, pos) AS r FROM al) WHERE r = 1),
 p AS (SELECT x.read_no, x."end" = 1 AS is_a, x.flag AS f1, x.contig AS c1, x.pos AS p1, x.seq, x.qual, y.flag AS f2, y.contig AS c2, y.pos AS p2 FROM b x JOIN b y ON x.read_no = y.read_no AND x."end" <> y."end"),
 o AS (SELECT *, CASE WHEN (read_no % 2 = 1) = (NOT is_a) THEN 64 ELSE 128 END AS first FROM p)"""


@twin(
    SAM_SQL
    + """ SELECT read_no, md5(printf('%010d', read_no) || chr(9) || cast(CASE WHEN (f1 & 4) <> 0 OR (f2 & 4) <> 0 THEN 0 ELSE f1 | 3 | CASE WHEN (f2 & 16) <> 0 THEN 32 ELSE 0 END | first END AS varchar) || chr(9) || c1 || chr(9)
 || cast(p1 AS varchar) || chr(9) || '255' || chr(9) || cast(length(seq) AS varchar) || 'M' || chr(9) || CASE WHEN c1 = c2 THEN '=' ELSE c2 END || chr(9) || cast(p2 AS varchar) || chr(9) || '0' || chr(9) || seq || chr(9) || qual) AS line_md5 FROM o"""
)
def a8_sam_pairs(spark, d):
    pairs, a = _sam_parts(spark, d, _sam_of_ends(spark, d))
    path = new_path(spark, "sam")
    contact_files.write_sam(pairs, a, path)
    back = spark.read.text(path).filter(~F.startswith("value", F.lit("@")))
    return back.select(F.substring("value", 1, 10).cast("long").alias("read_no"), F.md5("value").alias("line_md5"))


PAIR_LINE = """printf('%010d', read_no) || chr(9) || cast(CASE WHEN (f1 & 4) <> 0 OR (f2 & 4) <> 0 THEN 0 ELSE f1 | 3 | CASE WHEN (f2 & 16) <> 0 THEN 32 ELSE 0 END | first END AS varchar) || chr(9) || c1 || chr(9)
 || cast(p1 AS varchar) || chr(9) || '255' || chr(9) || cast(length(seq) AS varchar) || 'M' || chr(9) || CASE WHEN c1 = c2 THEN '=' ELSE c2 END || chr(9) || cast(p2 AS varchar) || chr(9) || '0' || chr(9) || seq || chr(9) || qual"""


@twin(f"{SAM_SQL}, n AS (SELECT row_number() OVER (ORDER BY read_no, first) + 1 AS line_no, {PAIR_LINE} AS line FROM o) SELECT line_no, md5(line) AS line_md5 FROM n UNION ALL SELECT 0, md5('@HD' || chr(9) || 'VN:1.0') UNION ALL SELECT 1, md5('@PG' || chr(9) || 'ID:contactloom')")
def a8_sam_file(spark, d):
    source = _sam_of_ends(spark, d)
    pairs, a = _sam_parts(spark, d, source)
    path = new_path(spark, "sam")
    contact_files.write_sam(pairs, a, path, contact_files.sam_header(spark, source[0]), "contactloom")
    lines = file_lines(spark.read.text(path)).select("path", "_block", "_line", F.md5("value").alias("line_md5"))
    return running_in_files(lines, {"line_no": F.lit(1)}, joined=True).select((F.col("line_no") - 1).alias("line_no"), "line_md5")


def _digest(spark, d, site: str = "^GATC_") -> DataFrame:
    contigs = views.view(spark, d, views.CONTIGS["spark"], "documents").withColumn("contig", F.concat(F.lit("chr"), F.col("contig").cast("string")))
    return digest.fragments(contigs, site, block=q.SMALL).withColumnRenamed("contig", "chr")


@twin(f"SELECT 'chr' || contig AS chr, 'chr' || contig AS contig, frag_idx, frag_start, frag_end, cast(1 AS int) AS mappability FROM ({ORACLE_PLAIN['d1_fragments']}) f")
def a10_fragment_file(spark, d):
    path = _put(spark, genome.fragments_text(_digest(spark, d)), "frags")
    return genome.read_fragments_text(spark, path)


NAMES_SQL = """WITH a AS (SELECT 'a' || n_nationkey AS contig, 'chr' || n_nationkey AS chr FROM nation WHERE n_nationkey < 15), b AS (SELECT 'b' || n_nationkey AS contig, 'chr' || n_nationkey AS chr FROM nation WHERE n_nationkey > 9),
 n AS (SELECT contig, chr || CASE WHEN chr IN (SELECT chr FROM b) THEN '.a' ELSE '' END AS chr FROM a UNION ALL SELECT contig, chr || CASE WHEN chr IN (SELECT chr FROM a) THEN '.b' ELSE '' END FROM b)"""


def _names(spark, d) -> tuple[DataFrame, DataFrame]:
    n = spark.read.parquet(f"{d}/nation.parquet")
    one = []
    for tag, rows in (("a", n.filter("n_nationkey < 15")), ("b", n.filter("n_nationkey > 9"))):
        lines = rows.select(F.concat(F.lit(f"{tag}"), "n_nationkey", F.lit(" chr"), "n_nationkey", F.lit("  # a comment")).alias("value"))
        one.append(genome.read_names(spark, _put(spark, lines, "names")))
    return genome.homologs(*one)


@twin(NAMES_SQL + " SELECT * FROM n")
def a11_names(spark, d):
    return _names(spark, d)[0].select("contig", "chr")


@twin(NAMES_SQL + " SELECT x.chr, CASE WHEN x.chr LIKE '%.a' THEN replace(x.chr, '.a', '.b') ELSE replace(x.chr, '.b', '.a') END AS partner FROM n x WHERE x.chr LIKE '%.%'")
def c7_partners(spark, d):
    return _names(spark, d)[1].select("chr", "partner")


#: Short regions; every tenth supplier's is 50 million bases long and holds others, every fifteenth's goes over 100 thousand.
REGIONS = """SELECT contig, start, start + CASE WHEN k % 40 = 7 THEN 50000000 WHEN k % 15 = 3 THEN 100000 ELSE 2000 END AS stop
 FROM (SELECT s_suppkey AS k, 'chr' || (s_suppkey % 3 + 1) AS contig, s_suppkey * 5000 + CASE WHEN s_suppkey % 40 = 7 THEN 4000000 ELSE 0 END AS start FROM supplier) s"""


def _regions(spark, d) -> str:
    s = spark.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey AS k")
    start = F.col("k") * 5000 + F.when(F.col("k") % 40 == 7, 4_000_000).otherwise(0)
    size = F.when(F.col("k") % 40 == 7, 50_000_000).when(F.col("k") % 15 == 3, 100_000).otherwise(2000)
    return _put(spark, s.select(F.concat_ws("\t", F.concat(F.lit("chr"), (F.col("k") % 3 + 1).cast("string")), start.cast("string"), (start + size).cast("string")).alias("value")), "regions")


@twin(f"WITH v AS ({V}), r AS ({REGIONS}) SELECT pair_id, line_no, EXISTS (SELECT 1 FROM r WHERE r.contig = v.chr_a AND v.start_a BETWEEN r.start AND r.stop) AS in_region FROM v")
def a13_in_regions(spark, d):
    rows = views.contacts(spark, d).select("pair_id", "line_no", "chr_a", "start_a")
    return genome.in_regions(rows, genome.regions(spark, _regions(spark, d)), "chr_a", "start_a").select("pair_id", "line_no", "in_region")


@twin(f"WITH r AS ({REGIONS}) SELECT 'track' AS source, contig, start FROM r")
def a12_mappability(spark, d):
    return genome.mappability(spark, {"track": _regions(spark, d)}).select("source", "contig", F.explode("starts").alias("start"))


@twin(f'''WITH al AS ({AL}), c AS (SELECT read_no, "end", count(*) FILTER ((flag & 4) = 0) AS n FROM al GROUP BY 1, 2),
 s AS (SELECT count(*) AS a, count(*) FILTER (n = 1) AS b, count(*) FILTER (n > 1) AS c, count(*) FILTER (n = 0) AS d FROM c)
 SELECT 'map' AS section, 'n_reads' AS key, a::double AS value FROM s UNION ALL SELECT 'map', 'uniq', b FROM s UNION ALL SELECT 'map', 'ambiguous', c FROM s UNION ALL SELECT 'map', 'unmapped', d FROM s''')
def a14_stats_file(spark, d):
    stats = contact_stats.as_stats(contact_stats.mapping_stats(q._alignments(spark, d)), "map", "s")
    with tempfile.TemporaryDirectory() as folder:  # some numbers, written and read by the driver
        stats_io.write_stats(stats, f"{folder}/stats.json")
        return stats_io.read_stats(spark, f"{folder}/stats.json", "s").select("section", "key", "value")


@twin("""SELECT 'acc' || doc_id AS contig, CASE WHEN doc_id % 2 = 0 THEN 'chr1_unloc_' || row_number() OVER (PARTITION BY doc_id % 2 = 0 ORDER BY 'acc' || doc_id) WHEN doc_id % 21 = 0 THEN 'chrMt' ELSE 'acc' || doc_id END AS chr FROM documents""")
def a19_contig_names(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    c = docs.select(F.concat(F.lit("acc"), F.col("doc_id").cast("string")).alias("contig"), F.lit(1_000_000).alias("size"), "doc_id")
    even = F.col("doc_id") % 2 == 0
    meta = c.select(F.col("contig").alias("accession"), F.when(even, "1").otherwise("").alias("chromosome"), F.when(~even & (F.col("doc_id") % 21 == 0), "Mitochondrion").otherwise("").alias("organelle"), even.alias("unlocalized"))
    return genome.name_contigs(c.select("contig", "size"), meta)


@twin("""WITH f AS (SELECT c_custkey AS k, '/x' || c_custkey % 10 || CASE WHEN c_custkey % 11 = 5 THEN '/t' || c_custkey ELSE '/s' || c_custkey || '_r_1' END || CASE WHEN c_custkey % 2 = 0 THEN '.fq.gz' ELSE '.fastq' END AS a FROM customer)
 SELECT a AS first, CASE WHEN k % 11 <> 5 AND k % 9 <> 4 THEN replace(a, 'r_1', 'r_2') END AS second, CASE WHEN k % 11 = 5 THEN 'one tag wanted' WHEN k % 9 = 4 THEN 'no partner' END AS error,
 CASE WHEN k % 11 <> 5 AND k % 9 <> 4 THEN '/x' || k % 10 || '/s' || k || '_r_1_2' END AS root, split_part(a, '.', 1) || '_clipped' || CASE WHEN k % 2 = 0 THEN '.fq.gz' ELSE '.fastq' END AS clipped FROM f""")
def a20_file_pairs(spark, d):
    k = F.col("c_custkey")
    name = F.when(k % 11 == 5, F.concat(F.lit("/t"), k)).otherwise(F.concat(F.lit("/s"), k, F.lit("_r_1")))
    first = F.concat(F.lit("/x"), k % 10, name, F.when(k % 2 == 0, ".fq.gz").otherwise(".fastq"))
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", first.alias("path"))
    mates = c.filter("c_custkey % 11 <> 5 and c_custkey % 9 <> 4").select(F.replace("path", F.lit("r_1"), F.lit("r_2")).alias("path"))
    pairs = files.pair_table(c.select("path").unionByName(mates))
    root, extension = files.root_and_extension(F.col("first"))
    return pairs.select("first", "second", "error", F.when(F.col("second").isNotNull(), files.merged_roots(F.col("first"), F.col("second"))).alias("root"), F.concat(root, F.lit("_clipped"), extension).alias("clipped"))


#: Sites from parts: cut marks at i and n - i, some blunt, some with an N at the end.
SITES = """WITH a AS (SELECT p_partkey AS k, translate(substr(md5(cast(p_partkey AS varchar)), 1, cast(4 + p_partkey % 3 AS int)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS s, cast(p_partkey % 5 AS int) AS i FROM part),
 b AS (SELECT k, CASE WHEN k % 7 = 0 THEN substr(s, 1, length(s) - 1) || 'N' ELSE s END AS s, least(i, length(s)) AS i FROM a), c AS (SELECT *, least(i, length(s) - i) AS lo, greatest(i, length(s) - i) AS hi, k % 6 = 1 AS blunt FROM b),
 p AS (SELECT *, substr(s, 1, cast(lo AS int)) AS l, substr(s, cast(lo + 1 AS int), cast(hi - lo AS int)) AS m, substr(s, cast(hi + 1 AS int)) AS r FROM c),
 x AS (SELECT k, s, l, m, r, blunt, CASE WHEN blunt THEN l || '^' || m || r WHEN i <= length(s) - i THEN l || '^' || m || '_' || r ELSE l || '_' || m || '^' || r END AS site FROM p)"""


@twin(SITES + " SELECT k AS part, site, s AS recognition, CASE WHEN blunt THEN s ELSE l || m || m || r END AS junction, replace(s, 'N', '[AGCT]') AS pattern FROM x")
def b14_sites(spark, d):
    table = spark.sql(SITES.replace("varchar", "string").replace("FROM part", "FROM {part}") + " SELECT k AS part, site FROM x", part=spark.read.parquet(f"{d}/part.parquet"))
    site = F.col("site")
    return table.select("part", "site", sites.recognitions(site).alias("recognition"), sites.junctions(site).alias("junction"), sites.site_patterns(site).alias("pattern"))


#: Of every part a site, a junction and an adapter, some of them unfit.
UNFIT = "CASE WHEN k % 9 = 2 THEN replace(site, '^', '') WHEN k % 9 = 3 THEN site || '^' WHEN k % 9 = 4 THEN site || 'X' WHEN k % 9 = 5 THEN lower(site) ELSE site END AS site, CASE WHEN k % 8 = 1 THEN s || '-' ELSE s END AS junction, s AS adapter"


@twin(f"{SITES}, u AS (SELECT k, {UNFIT} FROM x) SELECT k AS part, 'site' AS kind, site AS value, k % 9 NOT IN (2, 3, 4) AS ok FROM u UNION ALL SELECT k, 'junction', junction, k % 8 <> 1 FROM u UNION ALL SELECT k, 'adapter', adapter, NOT contains(adapter, 'N') FROM u")
def b15_checks(spark, d):
    u = spark.sql(SITES.replace("varchar", "string").replace("FROM part", "FROM {part}") + f" SELECT k AS part, {UNFIT} FROM x", part=spark.read.parquet(f"{d}/part.parquet"))
    fit = {"site": sites.site_error(F.col("site")).isNull(), "junction": sites.bases_fit(F.col("junction"), "AGCTN"), "adapter": sites.bases_fit(F.col("adapter"), "GCAT")}
    rows = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value"), ok.alias("ok")) for c, ok in fit.items()])
    return u.select("part", F.explode(rows).alias("x")).select("part", "x.*")


@twin(f"SELECT read_no, substr(seq, 6, greatest(length(seq) - 12, 0)) AS seq, substr(qual, 6, greatest(length(seq) - 12, 0)) AS qual FROM ({R}) r WHERE read_no <= 5000 AND length(seq) - 12 >= 18")
def b2_fixed_trim(spark, d):
    s = clip.ClipSettings("NOJUNCTION", "NOJUNCTION", min_quality=0, trim_5=5, trim_3=7, max_reads=5000, adapters=())
    return clip.clip(_reads(spark, d).select("read_no", "seq", "qual"), s)


@twin(f"""WITH r AS ({R}), a AS (SELECT *, instr(seq, 'GATC') AS i, CASE WHEN read_no % 5 = 3 THEN 3 ELSE 0 END AS tail FROM r)
 SELECT read_no, CASE WHEN i > 0 THEN substr(seq, 1, cast(i AS int) - 1) || 'GATCGAT' ELSE substr(seq, 1, cast(length(seq) - tail AS int)) END AS seq,
 CASE WHEN i = 0 THEN substr(qual, 1, cast(length(qual) - tail AS int)) ELSE rpad(substr(qual, 1, cast(i AS int) + 6), cast(i AS int) + 6, right(substr(qual, 1, cast(i AS int) + 6), 1)) END AS qual FROM a""")
def b8_padded_quality(spark, d):
    s = clip.ClipSettings("GATC", "GATCGAT", min_quality=0, min_length=0, adapters=())
    return clip.clip_all(_reads(spark, d).select("read_no", "seq", "qual"), s).select("read_no", "seq", "qual")


@twin(f"""WITH r AS ({R}), c AS (SELECT read_no, seq, instr(seq, 'GATCGATC') AS j FROM r), p AS (SELECT CASE WHEN j > 0 THEN instr(substr(seq, 1, cast(j AS int) - 1), 'GATC') ELSE instr(seq, 'GATC') END AS i FROM c),
 h AS (SELECT i - 1 AS pos, count(*) AS n FROM p WHERE i > 0 GROUP BY 1), sp AS (SELECT unnest(range((SELECT max(pos) FROM h) + 1)) AS pos)
 SELECT cast(sp.pos AS bigint) AS pos, coalesce(n, 0) AS n, round(100.0 * coalesce(n, 0) / (SELECT count(*) FROM p), 6) AS percent FROM sp LEFT JOIN h ON sp.pos = h.pos""")
def b11_recognition_positions(spark, d):
    s = clip.ClipSettings("GATCGATC", "GATC", min_quality=0, min_length=0, adapters=())
    return clip.position_histogram(clip.clip_all(_reads(spark, d).select("read_no", "seq", "qual"), s), "recog_at")


UNIQUE = f"""WITH {NORMAL}, rd AS (SELECT DISTINCT read_no FROM no), pp AS (SELECT a.read_no, count(*) AS c FROM no a JOIN no b ON a.read_no = b.read_no AND a.mate = 1 AND b.mate = 2 GROUP BY 1)
 SELECT read_no, CASE WHEN c IS NULL THEN 'unmapped_end' WHEN c = 1 THEN 'unique' ELSE 'ambiguous' END AS outcome, coalesce(c, 0) AS n_pairs FROM rd LEFT JOIN pp USING (read_no)"""


@twin(UNIQUE)
def e7_unique_map(spark, d):
    got = pairing.pair_reads(pairing.normalise(q._alignments(spark, d)), pairing.PairSettings(unique_map=True))
    return got.select("read_no", "outcome", F.size("pairs").cast("long").alias("n_pairs"))


#: Two genomes: alignments of an even supplier are of the second one; scores of some are perfect.
HYBRID = AL.replace("translate(substr(md5(cast(l_partkey", "cast(l_suppkey % 2 AS int) AS genome, translate(substr(md5(cast(l_partkey", 1).replace("% 13) AS as_score", "% 4) AS as_score")
HYBRID_SQL = (
    NORMAL.replace(AL, HYBRID).replace('SELECT read_no, "end" AS mate, contig AS chr,', 'SELECT read_no, genome, "end" AS mate, contig AS chr,').replace("no AS (SELECT read_no,", "no AS (SELECT read_no, genome,").split("y0 AS")[0]
    + """w0 AS (SELECT *, row_number() OVER (PARTITION BY read_no, mate ORDER BY chr DESC, start DESC, stop DESC, strand DESC, score DESC, genome DESC) AS r0, max(score) OVER (PARTITION BY read_no, mate) AS top,
  count(*) OVER (PARTITION BY read_no, mate) AS c, count(*) FILTER (score = 0) OVER (PARTITION BY read_no, mate) AS zeros FROM no),
w1 AS (SELECT *, min(CASE WHEN zeros = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY read_no) = 1 AND count(DISTINCT mate) OVER (PARTITION BY read_no) = 2 AS one FROM w0),
w2 AS (SELECT * FROM w1 WHERE CASE WHEN one THEN score = 0 ELSE c = 1 OR score > top - 9 END),
w3 AS (SELECT *, row_number() OVER (PARTITION BY read_no, mate ORDER BY r0) AS r, count(*) OVER (PARTITION BY read_no, mate) AS c2 FROM w2),
w4 AS (SELECT x.*, NOT one AND c2 >= 2 AND max(CASE WHEN r = 1 THEN chr END) OVER p = max(CASE WHEN r = 2 THEN chr END) OVER p AND abs(max(CASE WHEN r = 1 THEN start END) OVER p - max(CASE WHEN r = 2 THEN start END) OVER p) < 1000 AS two,
  max(CASE WHEN r = 1 THEN score END) OVER p >= max(CASE WHEN r = 2 THEN score END) OVER p AS first_wins FROM w3 x WINDOW p AS (PARTITION BY read_no, mate)),
ok AS (SELECT * FROM w4 WHERE NOT coalesce(two, false) OR r = CASE WHEN first_wins THEN 1 ELSE 2 END),
pr AS (SELECT a.read_no, a.genome AS ga, b.genome AS gb, a.score + b.score AS total, max(a.score + b.score) OVER (PARTITION BY a.read_no) AS best FROM ok a JOIN ok b ON a.read_no = b.read_no AND a.mate = 1 AND b.mate = 2),
kp AS (SELECT read_no, count(*) AS c, count(DISTINCT (ga, gb)) AS g, max(best) AS best FROM pr WHERE total >= best - 5 GROUP BY 1), rd AS (SELECT DISTINCT read_no FROM no)
SELECT read_no, CASE WHEN c IS NULL THEN 'unmapped_end' WHEN best < -24 THEN 'all_poor' WHEN c = 1 THEN 'unique' WHEN g = c THEN 'genome_ambiguous' ELSE 'position_ambiguous' END AS outcome,
 CASE WHEN best < -24 THEN 0 ELSE coalesce(c, 0) END AS n_pairs FROM rd LEFT JOIN kp USING (read_no)"""
)


@twin("WITH " + HYBRID_SQL)
def e6_hybrid_outcomes(spark, d):
    sql = views.ALIGNMENTS.replace("translate(substr(md5(cast(l_partkey", "cast(l_suppkey % 2 AS int) AS genome, translate(substr(md5(cast(l_partkey", 1).replace("% 13) AS as_score", "% 4) AS as_score")
    got = pairing.pair_reads(pairing.normalise(views.view(spark, d, sql, "lineitem")), pairing.PairSettings(hybrid=True))
    return got.select("read_no", "outcome", F.size("pairs").cast("long").alias("n_pairs"))


@twin(f"""WITH {NORMAL}, kr AS (SELECT *, ca > cb OR (ca = cb AND sa > sb) AS sw FROM kept WHERE best >= -24)
 SELECT read_no AS pair_id, CASE WHEN sw THEN cb ELSE ca END AS chr_a, CASE WHEN sw THEN sb ELSE sa END AS start_a, CASE WHEN sw THEN eb ELSE ea END AS end_a, CASE WHEN sw THEN ca ELSE cb END AS chr_b,
 CASE WHEN sw THEN sa ELSE sb END AS start_b, CASE WHEN sw THEN ea ELSE eb END AS end_b, size AS ambig_size, cast(sw AS int) AS swap_pair FROM kr""")
def e8_contact_rows(spark, d):
    return pairing.to_contacts(pairing.normalise(q._alignments(spark, d))).select("pair_id", "chr_a", "start_a", "end_a", "chr_b", "start_b", "end_b", "ambig_size", "swap_pair")


def _star_sql() -> str:
    """The filter's table with fragments cut at star sites where the size is too big, up to its sizes."""
    near = lambda x: f"CASE WHEN strand_{x} = '+' THEN coalesce(u{x}.pos, m{x}.hi) ELSE coalesce(d{x}.pos, m{x}.lo) END AS star_{x}"
    joins = " ".join(
        f"ASOF LEFT JOIN st u{x} ON n.chr_{x} = u{x}.chr AND n.start_{x} <= u{x}.pos ASOF LEFT JOIN st d{x} ON n.chr_{x} = d{x}.chr AND n.start_{x} > d{x}.pos LEFT JOIN mm m{x} ON n.chr_{x} = m{x}.chr" for x in "ab"
    )
    delta = lambda x: f"CASE WHEN strand_{x} = '+' THEN star_{x} - start_{x} ELSE start_{x} - star_{x} END"
    head = T.split("t0 AS")[0].rstrip().rstrip(",")
    return f"""WITH {head}, st AS (SELECT DISTINCT chr, frag_start AS pos FROM fr2), mm AS (SELECT chr, min(pos) AS lo, max(pos) AS hi FROM st GROUP BY chr),
 s0 AS (SELECT n.*, {near("a")}, {near("b")} FROM n {joins}),
 s1 AS (SELECT *, {delta("a")} AS ta, {delta("b")} AS tb, star_a IS NOT NULL AND star_b IS NOT NULL AND size > 450 AS big FROM s0),
 s2 AS (SELECT *, big AND f_start_a < star_a AND star_a < f_end_a AS in_a, big AND f_start_b < star_b AND star_b < f_end_b AS in_b FROM s1),
 s3 AS (SELECT *, in_a AND (NOT in_b OR da > db) AS first_a, in_b AND NOT (in_a AND (NOT in_b OR da > db)) AS first_b FROM s2),
 s4 AS (SELECT *, first_a OR (first_b AND in_a AND da + tb > 450) AS cut_a, first_b OR (first_a AND in_b AND ta + db > 450) AS cut_b FROM s3)
 SELECT pair_id, line_no, chr_a, start_a, chr_b, start_b, CASE WHEN idx_a IS NULL OR idx_b IS NULL THEN NULL ELSE (CASE WHEN coalesce(cut_a, false) THEN ta ELSE da END) + (CASE WHEN coalesce(cut_b, false) THEN tb ELSE db END) END AS size,
 coalesce(cut_a, false)::int + coalesce(cut_b, false)::int AS cuts FROM s4"""


@twin(_star_sql())
def f12_star_sizes(spark, d):
    stars = views.fragments_2(spark).select("chr", F.col("frag_start").alias("pos"))
    v, f = views.contacts(spark, d), views.fragments(spark)
    m = classify.measure(v, f, q.SIZES, None, stars)
    return m.select("pair_id", "line_no", "chr_a", "start_a", "chr_b", "start_b", "size", (F.col("cut_a").cast("int") + F.col("cut_b").cast("int")).alias("cuts"))


DUAL = f"bc AS (SELECT read_no, code AS code_1, substr(code, 4) || substr(code, 1, 3) AS code_2 FROM ({BC}) x), cd AS (SELECT code AS code_1, substr(code, 4) || substr(code, 1, 3) AS code_2, sample FROM ({CD}) y)"


@twin(f"""WITH {DUAL}, m1 AS (SELECT o.c AS code_1, v.code_1 AS match_1, hamming(o.c, v.code_1) AS distance_1 FROM (SELECT DISTINCT code_1 AS c FROM bc) o JOIN (SELECT DISTINCT code_1 FROM cd) v ON length(o.c) = length(v.code_1) AND hamming(o.c, v.code_1) <= 1),
 m2 AS (SELECT o.c AS code_2, v.code_2 AS match_2, hamming(o.c, v.code_2) AS distance_2 FROM (SELECT DISTINCT code_2 AS c FROM bc) o JOIN (SELECT DISTINCT code_2 FROM cd) v ON length(o.c) = length(v.code_2) AND hamming(o.c, v.code_2) <= 1),
 u1 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY code_1) AS n FROM m1) WHERE n = 1 OR distance_1 = 0), u2 AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY code_2) AS n FROM m2) WHERE n = 1 OR distance_2 = 0)
 SELECT bc.read_no, code_1, code_2, match_1, match_2, distance_1, distance_2, sample, match_1 IS NOT NULL AND match_2 IS NOT NULL AS valid FROM bc LEFT JOIN u1 USING (code_1) LEFT JOIN u2 USING (code_2) LEFT JOIN (SELECT code_1 AS match_1, code_2 AS match_2, sample FROM cd) c USING (match_1, match_2)""")
def c16_dual_codes(spark, d):
    reads, codes = q._codes(spark, d)
    second = F.concat(F.substring("code", 4, 10), F.substring("code", 1, 3)).alias("code_2")
    two = reads.select("read_no", F.col("code").alias("code_1"), second)
    valid = codes.select(F.col("code").alias("code_1"), second, "sample")
    return barcodes.demultiplex(two, valid, 1, dual=True).select("read_no", "code_1", "code_2", "match_1", "match_2", "distance_1", "distance_2", "sample", "valid")


ORACLE["c16_dual_codes_2"] = ORACLE["c16_dual_codes"].replace("<= 1)", "<= 2)")


def c16_dual_codes_2(spark, d):
    reads, codes = q._codes(spark, d)
    second = F.concat(F.substring("code", 4, 10), F.substring("code", 1, 3)).alias("code_2")
    two = reads.select("read_no", F.col("code").alias("code_1"), second)
    valid = codes.select(F.col("code").alias("code_1"), second, "sample")
    return barcodes.demultiplex(two, valid, 2, dual=True).select("read_no", "code_1", "code_2", "match_1", "match_2", "distance_1", "distance_2", "sample", "valid")


QUERIES["c16_dual_codes_2"] = c16_dual_codes_2


@twin("""WITH c AS (SELECT substr(md5(cast(event_id AS varchar)), 1, 16) AS code, event_id % 3 + 1 AS n FROM events)
 SELECT code, sum(n)::bigint AS n, round(100.0 * sum(n) / sum(sum(n)) OVER (), 6) AS percent, 'sample_' || row_number() OVER (ORDER BY sum(n) DESC, code DESC) AS sample FROM c GROUP BY code""")
def a24_many_samples(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    reads = e.select(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 16).alias("code"), F.explode(F.sequence(F.lit(0), F.col("event_id") % 3)).alias("i"))
    return barcodes.name_samples(barcodes.count_codes(reads)).select("code", "n", "percent", "sample")


@twin(f"WITH bc AS ({BC}), cd AS ({CD}) SELECT read_no, CASE WHEN code LIKE 'A%' THEN 'AA' ELSE code END || '_x' AS cell FROM bc WHERE code IN (SELECT code FROM cd WHERE code NOT LIKE 'C%')")
def c17_cells(spark, d):
    reads, codes = q._codes(spark, d)
    tagged = reads.select("read_no", F.concat(F.lit("@r 1:N:0:"), "code").alias("header"))
    inner = F.when(F.startswith("code", F.lit("A")), "AA").otherwise(F.col("code"))
    tags = codes.select(F.col("code").alias("tag"), inner.alias("inner_a"), F.when(F.startswith("code", F.lit("C")), "-").otherwise(inner).alias("inner_b"), F.lit("x").alias("outer"))
    return barcodes.demultiplex_cells(tagged, tags).select("read_no", "cell")


@twin(f"WITH r AS ({R}) SELECT a.read_no, '@r' || a.read_no || ' 1:N' AS header, a.seq || reverse(a.seq) AS seq, '+' AS plus, a.qual || a.qual AS qual FROM r a WHERE read_no % 5 <> 4")
def c18_spliced(spark, d):
    r = _reads(spark, d)
    side = lambda k, seq: r.select("read_no", F.concat("header", F.lit(f" {k}:N")).alias("header"), seq.alias("seq"), "qual")
    return barcodes.splice(side(1, F.col("seq")), side(2, F.reverse("seq")).filter("read_no % 5 <> 4"))


@twin(f"WITH m AS (SELECT read_no, CASE WHEN read_no % 3 = 0 THEN '_lost' ELSE 's' || (read_no % 3) END AS sample, seq FROM ({R}) r) SELECT sample, count(*) AS n, cast(sum(length(seq)) AS bigint) AS bases FROM m GROUP BY 1")
def a23_demultiplexed_files(spark, d):
    r = _reads(spark, d).withColumn("valid", F.col("read_no") % 3 != 0)
    matched = r.withColumn("sample", F.when(F.col("valid"), F.concat(F.lit("s"), (F.col("read_no") % 3).cast("string")))).withColumn("match", F.lit("x"))
    path = new_path(spark, "demux")
    fastq.write_demultiplexed(matched, path)
    back = fastq.read_fastq(spark, path + "/*").withColumn("sample", F.regexp_extract("path", "sample=([^/]+)", 1))
    return back.groupBy("sample").agg(F.count("*").alias("n"), F.sum(F.length("seq")).cast("long").alias("bases"))


@twin(f"""WITH {T}, {POS}, gr AS (SELECT pair_id, max(CASE WHEN chr_a <> chr_b AND (chr_a, chr_b) IN (('chr1', 'chr2'), ('chr2', 'chr1')) THEN 3 WHEN chr_a <> chr_b THEN 2 WHEN abs(pos_a - pos_b) < 10000 THEN 0 ELSE 1 END) AS code FROM pos GROUP BY 1)
 SELECT count(*) FILTER (code = 2) AS trans, count(*) FILTER (code = 3) AS homolog_trans FROM gr""")
def c7_homolog_contacts(spark, d):
    partners = spark.createDataFrame([("chr1", "chr2"), ("chr2", "chr1")], "chr string, partner string")
    return contact_stats.contact_stats(q._accepted(spark, d), partners).select("trans", "homolog_trans")


LINE_TEXT = " || ' ' || ".join(f"cast({c} AS varchar)" for c in ("chr_a", "start_a", "end_a", "f_start_a", "f_end_a", "strand_a", "chr_b", "start_b", "end_b", "f_start_b", "f_end_b", "strand_b", "pair_id"))


#: Runs of equal keys over all lines in order, with winners; a pair lives if every run it is in is its own.
RUNS_OF_LINES = f"""WITH {T}, l AS (SELECT *, {LINE_TEXT} AS line FROM acc), o AS (SELECT *, row_number() OVER (ORDER BY line) AS ln FROM l),
 c AS (SELECT *, CASE WHEN (chr_a, f_start_a, strand_a, chr_b, f_start_b, strand_b) IS NOT DISTINCT FROM lag((chr_a, f_start_a, strand_a, chr_b, f_start_b, strand_b)) OVER (ORDER BY ln) THEN 0 ELSE 1 END AS new FROM o),
 g AS (SELECT *, sum(new) OVER (ORDER BY ln ROWS UNBOUNDED PRECEDING) AS g, CASE WHEN ln = 1 THEN 0 ELSE abs(end_a - start_a) END + abs(end_b - start_b) AS len FROM c),
 w AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY ambig_size, len DESC, ln) = 1 AS winner, count(*) OVER (PARTITION BY g) AS run, max(g) OVER () AS top FROM g)"""


@twin(f"{RUNS_OF_LINES} SELECT pair_id, line_no, winner, run FROM w")
def h2_adjacent_runs(spark, d):
    return dedupe.winners(q._accepted(spark, d), dedupe.DedupeSettings(adjacent_only=True)).select("pair_id", "line_no", "winner", "run")


#: What a pair has gathered over the runs.
GATHERED_LINES = f"""{RUNS_OF_LINES}, x AS (SELECT *, max(CASE WHEN winner THEN pair_id END) OVER (PARTITION BY g) AS owner FROM w),
 p AS (SELECT pair_id, max(CASE WHEN NOT winner AND owner <> pair_id THEN 1 ELSE 0 END) AS lost, sum(CASE WHEN winner AND g < top THEN run ELSE 0 END) AS repeats, max(ambig_size) AS size FROM x GROUP BY 1)"""


@twin(f"{GATHERED_LINES} SELECT acc.pair_id, line_no, cast(repeats AS bigint) AS repeats FROM acc JOIN p USING (pair_id) WHERE lost = 0 AND repeats / p.size >= 2")
def g1_dedupe_lines(spark, d):
    return dedupe.dedupe(q._accepted(spark, d), dedupe.DedupeSettings(adjacent_only=True)).select("pair_id", "line_no", "repeats")


@twin(f"""{GATHERED_LINES} SELECT count(*) AS input_reads, count(*) FILTER (lost = 1) AS redundant, count(*) FILTER (lost = 0) AS effective, count(*) FILTER (lost = 0 AND repeats / size < 2) AS unique_reads,
 count(*) FILTER (lost = 0 AND repeats / size >= 2) AS supported, round(sum(repeats) FILTER (lost = 0) / count(*) FILTER (lost = 0), 6) AS mean_redundancy FROM p""")
def g2_dedupe_lines_stats(spark, d):
    return dedupe.dedupe_stats(q._accepted(spark, d), dedupe.DedupeSettings(adjacent_only=True))


@twin(f"""WITH {T}, {POS}, tr AS (SELECT chr, count(*) AS n FROM (SELECT chr_a AS chr FROM pos WHERE chr_a <> chr_b UNION ALL SELECT chr_b FROM pos WHERE chr_a <> chr_b) GROUP BY 1), sp AS (SELECT lim.chr, hi - lo + 1 AS span, coalesce(n, 0) AS n FROM lim LEFT JOIN tr USING (chr))
 SELECT chr, round(CASE WHEN n > 0 THEN log2((n / sum(n) OVER ()) / (span / sum(span) OVER ())) END, 9) AS deviation FROM sp""")
def j3_ploidy(spark, d):
    return contact_map.ploidy_deviation(contact_map.positions(q._accepted(spark, d)))


@twin(f"WITH {T} SELECT count(*) AS n, count(*) FILTER (chr_a = 'chr2' OR chr_b = 'chr2') AS mito, round(count(*) FILTER (chr_a = 'chr2' OR chr_b = 'chr2') / greatest(count(*), 1), 9) AS fraction FROM acc")
def j3_mito(spark, d):
    return contact_map.mito_fraction(q._accepted(spark, d), ("chr2",))


def _filter_sql(name: str, relay: str | None, isolated: bool) -> str:
    """CTE `name` (pair_id, k, on): the rows that the network filter keeps active."""
    ok = "NOT gone" + (f" AND (chr_a = chr_b OR coalesce(relay, 0.0) >= coalesce((SELECT limit_ FROM {relay}_limit), 0.0))" if relay else "")
    join = f"LEFT JOIN {relay} USING (chr_a, chr_b)" if relay else ""
    at = lambda i: f"coalesce(p[{i + 1}].s, 0.0)"
    top = lambda i: f"list_transform(p[1:{i}], lambda x: x.k)"
    every = "list_transform(p, lambda x: x.k)"
    good = "list_transform(list_filter(p, lambda x: x.ok), lambda x: x.k)"
    partly = "partly"
    tentative = f"CASE WHEN {partly} THEN {good} ELSE {every} END"
    low = "[]::bigint[]" if isolated else f"({tentative})"
    return f"""{name}_m AS (SELECT pair_id, k, chr_a, chr_b, mi.chr IS NOT NULL AS gone, own, score FROM am LEFT JOIN mi ON chr_a = mi.chr AND chr_b = mi.chr),
{name}_s AS (SELECT pair_id, k, CASE WHEN own AND NOT gone THEN coalesce(score, 0.0) ELSE 0.0 END AS s, {ok} AS ok FROM {name}_m {join}),
{name}_g AS (SELECT pair_id, list({{'s': s, 'k': k, 'ok': ok}} ORDER BY s DESC, k DESC) AS p FROM {name}_s GROUP BY 1),
{name}_h AS (SELECT *, len(list_filter(p, lambda x: x.ok)) AS n_ok, len(list_filter(p, lambda x: x.ok)) BETWEEN 1 AND len(p) - 1 AS partly FROM {name}_g),
{name}_k AS (SELECT pair_id, CASE WHEN partly AND n_ok = 1 THEN CASE WHEN list_filter(p, lambda x: x.ok)[1].s > 0 THEN {good} ELSE []::bigint[] END WHEN {at(0)} < 1.0 THEN {low}
  WHEN {at(0)} > 1.2 * {at(1)} THEN {top(1)} WHEN {at(1)} > 1.2 * {at(2)} THEN {top(2)} WHEN {at(2)} > 1.2 * {at(3)} THEN {top(3)} ELSE ({tentative}) END AS keep FROM {name}_h),
{name} AS (SELECT lb.pair_id, lb.k, CASE WHEN n = 1 THEN true WHEN n > 16 THEN false ELSE list_contains(keep, lb.k) END AS on_ FROM lb LEFT JOIN {name}_k USING (pair_id))"""


RELAY = """lf AS (SELECT pair_id, chr_a, chr_b, count(*) OVER (PARTITION BY pair_id) AS n FROM lb JOIN first USING (pair_id, k) WHERE on_), fc AS (SELECT chr_a, chr_b, count(*) AS c FROM lf WHERE n = 1 AND chr_a <> chr_b GROUP BY 1, 2),
fb AS (SELECT * FROM fc UNION ALL SELECT chr_b, chr_a, c FROM fc), relay AS (SELECT chr_a, chr_b, round(sum(v), 9) AS relay FROM (SELECT x.chr_a, y.chr_a AS chr_b, sqrt(x.c * y.c) AS v FROM fb x JOIN fb y ON x.chr_b = y.chr_b AND x.chr_a < y.chr_a
 UNION ALL SELECT chr_a, chr_b, 5.0::double * c FROM fc) GROUP BY 1, 2), relay_limit AS (SELECT quantile_cont(v, 0.05) AS limit_ FROM (SELECT relay AS v FROM relay WHERE relay > 0 UNION ALL SELECT relay FROM relay WHERE relay > 0))"""
MISSING = "mi AS (SELECT chr FROM (SELECT chr_a AS chr FROM lb UNION SELECT chr_b FROM lb) c LEFT JOIN (SELECT chr_a AS chr, n_unambig FROM pc WHERE chr_a = chr_b) USING (chr) WHERE coalesce(n_unambig, 0) < 5)"
AMBIGUOUS = """ob AS (SELECT DISTINCT chr_a, chr_b, bin_a, bin_b, true AS own FROM lb WHERE n = 1),
am AS (SELECT pair_id, k, chr_a, chr_b, coalesce(own, false) AS own, score FROM lb LEFT JOIN ob USING (chr_a, chr_b, bin_a, bin_b) LEFT JOIN sc USING (chr_a, chr_b, pos_a, pos_b) WHERE n > 1 AND n <= 16)"""
FIRST = f"{T}, {LOADED}, {PAIRS}, {MISSING}, {SCORES}, {AMBIGUOUS}, {_filter_sql('first', None, False)}"


@twin(f"WITH {FIRST} SELECT pair_id, k, on_ AS active FROM first")
def i6_network_filter(spark, d):
    df = q.written("contacts", q._numbered(spark, d))
    loaded = q.written("loaded", disambiguate.load(df, q.PLACE))
    return disambiguate.network_filter(df, q.PLACE, disambiguate.missing_cis(loaded, q.PLACE), loaded=loaded).select("pair_id", "k", "active")


@twin(f"WITH {FIRST}, {RELAY} SELECT round(limit_, 6) AS relay_limit FROM relay_limit")
def g11_relay_limit(spark, d):
    df = q.written("contacts", q._numbered(spark, d))
    loaded = q.written("loaded", disambiguate.load(df, q.PLACE))
    first = disambiguate.network_filter(df, q.PLACE, disambiguate.missing_cis(loaded, q.PLACE), loaded=loaded)
    relay = q.written("relay", disambiguate.trans_relay(disambiguate.load(first, q.PLACE), q.PLACE))
    return disambiguate.relay_limit(relay, q.PLACE).select(F.round("limit", 6).alias("relay_limit"))


ORACLE["i8_resolved"] = f"WITH {FIRST}, {RELAY}, {_filter_sql('last', 'relay', True)} SELECT pair_id, count(*) AS rows_in, count(*) FILTER (on_) AS kept FROM last GROUP BY 1"


#: The first stage's rows with what it leaves active, and both stages.
ISOLATED = ORACLE_PLAIN["i4_without_isolated"].rsplit(" SELECT pair_id, count(*)", 1)[0]
STAGE_1 = ISOLATED + " SELECT *, CASE WHEN m = 0 OR pair_id IN (SELECT pair_id FROM iso) THEN false WHEN m < n AND m > 1 THEN keep ELSE true END AS on_ FROM km"
LEFT = f"lb AS MATERIALIZED (SELECT pair_id, k, chr_a, chr_b, pos_a, pos_b, bin_a, bin_b, count(*) OVER (PARTITION BY pair_id) AS n FROM ({STAGE_1}) s1 WHERE on_)"


@twin(f"WITH {LEFT}, {PAIRS}, {MISSING}, {SCORES}, {AMBIGUOUS}, {_filter_sql('first', None, False)}, {RELAY}, {_filter_sql('last', 'relay', True)} SELECT pair_id, k FROM last WHERE on_")
def i10_disambiguated(spark, d):
    return disambiguate.disambiguate(q._numbered(spark, d), q.PLACE).filter("active").select("pair_id", "k")


@twin("SELECT 'cell' || s_suppkey AS root, 'a/cell' || s_suppkey || '.ncc' AS ncc_path, CASE WHEN s_suppkey % 3 = 0 THEN 'b/cell' || s_suppkey || '_stats.json' END AS json_path FROM supplier")
def c14_files_by_root(spark, d):
    s = spark.read.parquet(f"{d}/supplier.parquet")
    path = lambda folder, end: F.concat(F.lit(folder + "/cell"), F.col("s_suppkey").cast("string"), F.lit(end)).alias("path")
    return contact_stats.join_by_root(s.select(path("a", ".ncc")), s.filter("s_suppkey % 3 = 0").select(path("b", "_stats.json")))


@twin(f"WITH co AS ({CO}) SELECT cast(contig AS varchar) AS contig, length(seq) AS size FROM co")
def a18_contig_sizes(spark, d):
    return genome.contig_sizes(spark, _fasta(spark, d)).select("contig", F.col("size").cast("long").alias("size"))


@twin(f"SELECT 'chr' || contig AS chr, frag_idx, frag_start, frag_end FROM ({ORACLE_PLAIN['d1_fragments'].replace('GATC', 'AGCT')}) f")
def d3_fragment_cache(spark, d):
    path = new_path(spark, "cache")
    genome.write_fragments(_digest(spark, d), path, "MboI")
    genome.write_fragments(_digest(spark, d, "AG^CT"), path, "AluI")
    return genome.read_fragments(spark, path, "AluI").select("chr", "frag_idx", "frag_start", "frag_end")


@twin(f"WITH {NORMAL} SELECT read_no, mate, CASE chr WHEN 'c1' THEN 'NATION_1' WHEN 'c2' THEN 'NATION_2' ELSE chr END AS chr, start FROM no")
def c6_renamed(spark, d):
    names = spark.read.parquet(f"{d}/nation.parquet").filter("n_nationkey in (1, 2)").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("contig"), F.col("n_name").alias("chr"))
    return pairing.normalise(q._alignments(spark, d), names).select("read_no", F.col("end").alias("mate"), "aln.chr", "aln.start")


DENSITY = """, s AS (SELECT *, CASE WHEN sum(n) FILTER (series = 'cis') OVER () > 0 THEN 0.01 * sum(n) FILTER (series = 'cis') OVER () ELSE 1.0 END AS c, CASE WHEN sum(n) FILTER (series = 'trans') OVER () > 0 THEN 0.01 * sum(n) FILTER (series = 'trans') OVER () ELSE 1.0 END AS r FROM h)
 SELECT series, bin, bin / 10.0 AS edge, n, round(n / CASE series WHEN 'cis' THEN c WHEN 'trans' THEN r ELSE c + r END, 9) AS percent FROM s"""


@twin(f"WITH h AS ({ORACLE_PLAIN['f_size_histogram']}){DENSITY}")
def f15_size_density(spark, d):
    return classify.size_density(classify.size_histogram(q._tagged(spark, d)))


@twin(f"WITH h AS ({ORACLE_PLAIN['f_junction_histogram']}), e AS (SELECT bin, strand FROM (SELECT unnest(range(100)) AS bin) b CROSS JOIN (VALUES ('+'), ('-')) t(strand)) SELECT e.strand, (e.bin + 1) * 10 AS edge, coalesce(n, 0) / 10.0 AS per_base FROM e LEFT JOIN h USING (strand, bin)")
def f15_junction_density(spark, d):
    return classify.junction_density(classify.junction_histogram(q._tagged(spark, d, together=False)))


SAMPLES = f"""WITH {NORMAL}, {T}, {POS}, z_mp AS (SELECT read_no, "end", count(*) FILTER ((flag & 4) = 0) AS n FROM al GROUP BY 1, 2),
 z_m AS (SELECT read_no % 4 AS s, count(*) AS reads, count(*) FILTER (n > 0) AS mapped FROM z_mp GROUP BY 1),
 z_rd AS (SELECT DISTINCT read_no FROM no), z_kp AS (SELECT read_no, max(size) AS size, max(best) AS best FROM kept GROUP BY 1),
 z_pr AS (SELECT read_no % 4 AS s, count(*) AS total, count(*) FILTER (best >= -24 AND z_kp.size > 1) AS amb FROM z_rd LEFT JOIN z_kp USING (read_no) GROUP BY 1),
 z_fl AS (SELECT pair_id % 4 AS s, count(*) AS total, count(*) FILTER (tag = 'accepted') AS acc, count(*) FILTER (tag IN ('adjacent_re1', 'overhang_re1', 'too_close', 'no_insert', 'too_small', 'too_big', 'no_end_re2', 'internal_re2')) AS other FROM t GROUP BY 1),
 z_gr AS (SELECT pair_id, max(CASE WHEN chr_a <> chr_b THEN 2 WHEN abs(pos_a - pos_b) < 10000 THEN 0 ELSE 1 END) AS code FROM pos GROUP BY 1),
 z_fi AS (SELECT pair_id % 4 AS s, count(*) AS total, count(*) FILTER (code = 0) AS near, count(*) FILTER (code = 1) AS far, count(*) FILTER (code = 2) AS trans FROM z_gr GROUP BY 1)
 SELECT 's' || s AS sample, reads, round(100.0 * mapped / reads, 6) AS pc_map, round(100.0 * amb / z_pr.total, 6) AS pc_ambiguous, round(100.0 * acc / z_fl.total, 6) AS pc_accepted, round(100.0 * other / z_fl.total, 6) AS pc_other,
 round(100.0 * near / z_fi.total, 6) AS pc_near, round(100.0 * far / z_fi.total, 6) AS pc_far, round(100.0 * trans / z_fi.total, 6) AS pc_trans FROM z_m JOIN z_pr USING (s) JOIN z_fl USING (s) JOIN z_fi USING (s)"""


@twin(SAMPLES)
def g14_sample_table_whole(spark, d):
    """All columns of the table, of samples told by the last two bits of read numbers."""
    of = lambda c: F.concat(F.lit("s"), (F.col(c) % 4).cast("string")).alias("sample")

    def tidy(df: DataFrame, section: str, *sums) -> DataFrame:
        wide = df.groupBy("sample").agg(*sums)
        pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in wide.columns[1:]])
        return wide.select("sample", F.lit(section).alias("section"), F.explode(pairs).alias("x")).select("sample", "section", "x.*")

    def outcomes(df: DataFrame, section: str, key: str, total: str) -> DataFrame:
        # counts are made once, and the total of them
        counts = df.groupBy("sample", F.col(key).alias("key")).agg(F.count("*").alias("n"))
        both = counts.select("sample", "n", F.explode(F.array("key", F.lit(total))).alias("key"))
        return both.groupBy("sample", "key").agg(F.sum("n").cast("double").alias("value")).select("sample", F.lit(section).alias("section"), "key", "value")

    alignments = q._alignments(spark, d)
    n = F.count_if(F.col("flag").bitwiseAND(4) == 0)
    mapped = alignments.groupBy("read_no", "end").agg(n.alias("n")).select(of("read_no"), "n")
    stats = tidy(mapped, "map", F.count("*").alias("n_reads"), F.count_if(F.col("n") == 1).alias("uniq"), F.count_if(F.col("n") > 1).alias("ambiguous"))
    stats = stats.unionByName(outcomes(pairing.pair_reads(pairing.normalise(alignments)).select(of("read_no"), "outcome"), "pair", "outcome", "total"))
    tagged = q.written("tagged", q._tagged(spark, d).select("pair_id", "tag", *[f"{c}_{x}" for x in "ab" for c in ("chr", "strand", "f_start", "f_end")]))
    stats = stats.unionByName(outcomes(tagged.select(of("pair_id"), "tag"), "filter", "tag", "input_pairs"))
    final = contact_stats.group_classes(tagged.filter("tag = 'accepted'")).select(of("pair_id"), "code")
    sums = [F.count("*").alias("total_contacts"), *[F.count_if(F.col("code") == i).alias(c) for i, c in enumerate(("cis_near", "cis_far", "trans"))]]
    return contact_stats.sample_table(stats.unionByName(tidy(final, "final", *sums)))
