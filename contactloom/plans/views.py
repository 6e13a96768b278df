"""Contact-like tables derived from the driver's tables, by SQL that both engines run.

{name} stands for a table. Arithmetic stays in whole numbers; division goes through floor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CONTACTS = """
SELECT pair_id, chr_a, start_a, start_a + (CASE WHEN strand_a = '+' THEN 70 ELSE -70 END) AS end_a, strand_a,
       chr_b, start_b, start_b + (CASE WHEN strand_b = '+' THEN 70 ELSE -70 END) AS end_b, strand_b, ambig_size, line_no
FROM (
  SELECT l_orderkey AS pair_id, l_linenumber AS line_no,
         CASE WHEN loc % 97 = 5 THEN 'chrU' ELSE 'chr' || cast(1 + loc % 3 AS string) END AS chr_a,
         100 + (loc * 104729) % 4900000 + l_partkey % 20 AS start_a,
         CASE WHEN loc % 4 = 0 THEN '-' ELSE '+' END AS strand_a,
         'chr' || cast(1 + (loc + (CASE WHEN m <= 36 THEN 0 ELSE 1 END)) % 3 AS string) AS chr_b,
         100 + ((loc * 104729) % 4900000 + (CASE WHEN m <= 5 THEN m * 20 WHEN m <= 14 THEN m * 50 WHEN m <= 24 THEN m * 300 ELSE (loc * 7919) % 4900000 END)) % 4900000 + l_suppkey % 20 AS start_b,
         CASE WHEN loc % 3 = 0 THEN '+' ELSE '-' END AS strand_b,
         count(*) OVER (PARTITION BY l_orderkey) AS ambig_size
  FROM (SELECT *, loc % 50 AS m FROM (SELECT *, cast(floor(l_orderkey / 3.0) AS bigint) * 7 + l_linenumber AS loc FROM {lineitem}) x) y
) z
"""

#: 3 chromosomes of 25,000 fragments with gaps between some of them.
FRAGMENTS = {
    "spark": """
SELECT 'chr' || cast(c AS string) AS chr, k AS frag_idx, k * 200 + (k * 37) % 100 AS frag_start,
       (k + 1) * 200 + ((k + 1) * 37) % 100 - 1 - k % 7 AS frag_end
FROM (SELECT explode(sequence(1, 3)) AS c) CROSS JOIN (SELECT id AS k FROM range(25000))
""",
    "duckdb": """
SELECT 'chr' || cast(c AS string) AS chr, k AS frag_idx, k * 200 + (k * 37) % 100 AS frag_start,
       (k + 1) * 200 + ((k + 1) * 37) % 100 - 1 - k % 7 AS frag_end
FROM (SELECT unnest(range(1, 4)) AS c) a CROSS JOIN (SELECT unnest(range(25000)) AS k) b
""",
}
#: A coarser second digest that lacks chr3.
FRAGMENTS_2 = {
    k: f"SELECT chr, cast(frag_idx / 5 AS bigint) AS frag_idx, min(frag_start) AS frag_start, max(frag_end) AS frag_end FROM (SELECT chr, cast(floor(frag_idx / 5.0) AS bigint) * 5 AS frag_idx, frag_start, frag_end FROM ({v}) f) g WHERE chr <> 'chr3' GROUP BY 1, 2"
    for k, v in FRAGMENTS.items()
}

HEX, BASES, QUALITIES = "0123456789abcdef", "ACGTACGTACGTACGT", "#&+05:?DEFGHIIII"
READS = f"""
SELECT read_no, CASE WHEN read_no % 5 = 1 THEN substr(s, 1, cast(p AS int)) || 'GATCGATC' || substr(s, cast(p AS int) + 1, 96)
                     WHEN read_no % 5 = 2 THEN substr(s, 1, cast(p AS int)) || 'AGATCGGAAGAGC'
                     WHEN read_no % 5 = 3 THEN s || 'NNN' ELSE s END AS seq,
       CASE WHEN read_no % 5 = 1 THEN q || 'IIIIIIII' WHEN read_no % 5 = 2 THEN substr(q, 1, cast(p AS int) + 13)
            WHEN read_no % 5 = 3 THEN q || 'III' ELSE q END AS qual
FROM (
  SELECT o_orderkey AS read_no, o_orderkey % 80 + 4 AS p,
         translate(md5('a' || cast(o_orderkey AS string)) || md5('b' || cast(o_orderkey AS string)) || md5('c' || cast(o_orderkey AS string)), '{HEX}', '{BASES}') AS s,
         translate(md5('q' || cast(o_orderkey AS string)) || md5('r' || cast(o_orderkey AS string)) || md5('s' || cast(o_orderkey AS string)), '{HEX}', '{QUALITIES}') AS q
  FROM {{orders}}
) t
"""

BARCODED = f"""
SELECT event_id AS read_no, CASE WHEN event_id % 11 = 3 THEN substr(bc, 1, 5) || 'A' ELSE bc END AS code
FROM (SELECT event_id, translate(substr(md5(cast(user_id % 40 AS string)), 1, 6), '{HEX}', '{BASES}') AS bc FROM {{events}}) t
"""
CODES = f"""
SELECT DISTINCT translate(substr(md5(cast(c_custkey % 40 AS string)), 1, 6), '{HEX}', '{BASES}') AS code,
       's' || translate(substr(md5(cast(c_custkey % 40 AS string)), 1, 6), '{HEX}', '{BASES}') AS sample FROM {{customer}} WHERE c_custkey % 40 < 30
"""

#: Letters to bases, everything else to N.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTER_BASES = "ACGT" * 13
CONTIGS = {
    "spark": f"SELECT doc_id AS contig, translate(regexp_replace(text, '[^A-Za-z]', '.'), '{LETTERS}.', '{LETTER_BASES}N') AS seq FROM {{documents}}",
    "duckdb": f"SELECT doc_id AS contig, translate(regexp_replace(text, '[^A-Za-z]', '.', 'g'), '{LETTERS}.', '{LETTER_BASES}N') AS seq FROM documents",
}

ALIGNMENTS = f"""
SELECT l_orderkey AS read_no, cast(1 + l_linenumber % 2 AS int) AS "end", cast(CASE WHEN l_returnflag = 'R' THEN 16 WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 4 ELSE 0 END AS int) AS flag,
       'c' || cast(1 + l_partkey % 3 AS string) AS contig, 1000 + l_suppkey * 300 + l_partkey % 1500 AS pos,
       -(cast(floor(l_quantity) AS bigint) % 13) AS as_score,
       CASE WHEN l_linenumber = 3 THEN '0A49' WHEN l_linenumber = 4 THEN '49C0' ELSE '50' END AS md,
       translate(substr(md5(cast(l_partkey AS string)) || md5(cast(l_suppkey AS string)), 1, 50), '{HEX}', '{BASES}') AS seq,
       translate(substr(md5(cast(l_suppkey AS string)) || md5(cast(l_partkey AS string)), 1, 50), '{HEX}', '{QUALITIES}') AS qual
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_partkey, l_suppkey, l_quantity FROM {{lineitem}}) t
"""


def view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    return spark.sql(sql.replace('"end"', "`end`"), **frames)


def contacts(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """`together`: rows of a pair_id in one place from the start, so that windows over it need no shuffle of wider rows."""
    if not together:
        return view(spark, sf_dir, CONTACTS, "lineitem")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return spark.sql(CONTACTS, lineitem=rows.repartition("l_orderkey"))


def alignments(spark: SparkSession, sf_dir: str, sql: str = ALIGNMENTS) -> DataFrame:
    """Rows of a read in one place, as an aligner writes them: what groups them by read needs no shuffle after this one."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey", "l_quantity")
    return spark.sql(sql.replace('"end"', "`end`"), lineitem=rows.repartition("l_orderkey"))


def fragments(spark: SparkSession) -> DataFrame:
    return spark.sql(FRAGMENTS["spark"])


def fragments_2(spark: SparkSession) -> DataFrame:
    return spark.sql(FRAGMENTS_2["spark"]).selectExpr("chr", "cast(frag_idx as bigint) as frag_idx", "frag_start", "frag_end")


def plain(sql: str) -> str:
    """The DuckDB text of a view: table names as they are."""
    for t in ("lineitem", "orders", "events", "customer", "documents"):
        sql = sql.replace("{" + t + "}", t)
    return sql
