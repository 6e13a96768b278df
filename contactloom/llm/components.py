"""Connected components of a graph, by least labels and pointer jumping.

Edge cases: an edge from a node to itself says nothing, and a node that has no other is in no row; edges may be repeated and go
either way; null nodes are left out; without edges there are no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import write_table


def connected_components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of edges (a, b): comp is the least node that it is connected with.

    In each round a node takes the least label among its neighbours, then its label's label. Labels are written each
    round. Joins are on single nodes, so a node with very many edges is one of Spark's skewed join keys, and sums by
    node start on the map side.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = write_table(spark, both.filter("a <> b").distinct(), "graph")
    labels = write_table(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "labels")
    for _ in range(rounds):
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "comp", F.lit(None).cast("long").alias("old"))
        best = near.unionByName(labels.select("node", "comp", F.col("comp").alias("old"))).groupBy("node").agg(F.min("comp").alias("comp"), F.max("old").alias("old"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = best.join(jump, "comp").select("node", F.col("further").alias("comp"), "old")
        new = write_table(spark, new, "labels")
        moved = new.filter("comp <> old").limit(1).count()
        labels = new.select("node", "comp")
        if not moved:
            return labels
    raise RuntimeError("the labels have not settled")
