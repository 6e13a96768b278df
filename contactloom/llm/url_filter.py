"""URL filters: host and path rules, and trust and distrust spread over the host graph.

Rules settle the pages they fit. For the rest, hosts mostly allowed by rules are trusted seeds and hosts mostly
blocked are blocked seeds. Personalised PageRank runs from the trusted ones along the links, and from the blocked
ones against them (who links to a blocked host is distrusted); a host whose distrust outweighs its trust is blocked.

Links are aggregated to host pairs before any join. The join with the ranks is salted by the target host, so one host
with very many links is dealt to several tasks. Each iteration is written to the shared folder.

Edge cases: a null url, or one without "://", has empty host and path, fits no rule and is allowed; links inside a
host are ignored; null html has no links; repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import write_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, rule); a rule is a host, then the start of a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
SALTS = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); host with A-Z lower-cased, both empty where there is no "://"."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(u, URL, 1), UPPER, LOWER), F.regexp_extract(u, URL, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, by regular expression over the html."""
    src, _ = split_url(F.col("url"))
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER)))
    rows = pages.filter("html is not null").select(src.alias("src"), F.explode(links).alias("dst"))
    return rows.filter("src <> '' and dst <> src").groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(
    spark: SparkSession, edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 300, tol: float = 1e-4
) -> DataFrame:
    """(host, trust, distrust) from edges (src, dst, n) and seeds (host, trust, distrust: starting shares).

    Goes on until no rank moves by more than `tol` of a seed's share, which the damping brings about in some 60 rounds;
    more than `rounds` are an error.
    """
    pairs = write_table(spark, edges, "edges")

    def shares(kind: str, a: str, b: str) -> DataFrame:
        """Transition shares; the sums go back to the pairs by a join salted by the target."""
        salt = F.pmod(F.xxhash64(b), F.lit(SALTS)).cast("int")
        total = pairs.groupBy(a).agg(F.sum("n").alias("total")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return pairs.withColumn("salt", salt).join(total, [a, "salt"]).select(
            F.lit(kind).alias("kind"), F.col(a).alias("frm"), F.col(b).alias("to"), "salt", (F.col("n") / F.col("total")).alias("share")
        )

    graph = write_table(spark, shares("trust", "src", "dst").unionByName(shares("distrust", "dst", "src")), "graph")
    totals = seeds.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    least = tol / max(totals["t"] or 0.0, totals["d"] or 0.0, 1.0)
    start = write_table(
        spark,
        seeds.select(
            "host",
            F.explode(
                F.array(
                    F.struct(F.lit("trust").alias("kind"), (F.col("trust") / (totals["t"] or 1.0)).alias("s")),
                    F.struct(F.lit("distrust").alias("kind"), (F.col("distrust") / (totals["d"] or 1.0)).alias("s")),
                )
            ).alias("x"),
        ).select("x.kind", "host", "x.s").filter("s > 0"),
        "seeds",
    )
    ranks = start.select("kind", "host", F.col("s").alias("r"), F.lit(1.0).alias("moved"))
    if not graph.isEmpty():
        for _ in range(rounds):
            salted = ranks.select("kind", F.col("host").alias("frm"), "r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
            flow = graph.join(salted, ["kind", "frm", "salt"]).select("kind", F.col("to").alias("host"), (F.col("share") * F.col("r") * damping).alias("x"))
            parts = (
                flow.withColumn("old", F.lit(0.0))
                .unionByName(start.select("kind", "host", (F.col("s") * (1 - damping)).alias("x"), F.lit(0.0).alias("old")))
                .unionByName(ranks.select("kind", "host", F.lit(0.0).alias("x"), F.col("r").alias("old")))
            )
            summed = parts.groupBy("kind", "host").agg(F.sum("x").alias("r"), F.sum("old").alias("old"))
            ranks = write_table(spark, summed.select("kind", "host", "r", F.abs(F.col("r") - F.col("old")).alias("moved")), "ranks")
            if (ranks.agg(F.max("moved")).first()[0] or 0.0) <= least:
                break
        else:
            raise RuntimeError("the ranks have not settled")
    pick = lambda k: F.sum(F.when(F.col("kind") == k, F.col("r")).otherwise(0.0)).alias(k)
    return ranks.groupBy("host").agg(pick("trust"), pick("distrust"))


def judge(
    spark: SparkSession,
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    seed_share: float = 0.5,
    block_at: float = 0.5,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """pages[keep] with host, path, rule and verdict, and the host's trust and distrust (null where it has none).

    A host is a seed when over `seed_share` of its pages fall under rules of one kind; a host is blocked when
    distrust / (trust + distrust) is over `block_at`.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    share = lambda v: F.count_if(F.col("_r.verdict") == v) / F.count("*")
    hosts = rows.filter("host <> ''").groupBy("host").agg(share("allow").alias("a"), share("block").alias("b"))
    seeds = write_table(
        spark,
        hosts.select(
            "host",
            F.when(F.col("a") > seed_share, 1.0).otherwise(0.0).alias("trust"),
            F.when(F.col("b") > seed_share, 1.0).otherwise(0.0).alias("distrust"),
        ).filter("trust + distrust > 0"),
        "hosts",
    )
    ranks = spread(spark, host_edges(pages), seeds)
    salted = ranks.select(F.col("host").alias("_h"), "trust", "distrust", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(*keep, "path"), F.lit(SALTS)).cast("int")).withColumn("_h", F.col("host"))
    got = left.join(salted, ["_h", "_salt"], "left")
    bad = F.coalesce(F.col("distrust") > block_at * (F.col("trust") + F.col("distrust")), F.lit(False))
    return got.select(
        *keep,
        "host",
        "path",
        F.col("_r.rule").alias("rule"),
        F.coalesce(F.col("_r.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "trust",
        "distrust",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: host, path, rule and verdict of every page."""
    return judge(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))
