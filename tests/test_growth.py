"""What keeps queries in proportion to their input: the plans and the generated code of their shared steps."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactloom.functions import neighbours
from contactloom.operators import assign, disambiguate
from contactloom.plans import queries, views
from contactloom.sources import contacts


def _text(df, mode: str) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


@pytest.fixture
def small_broadcasts(spark):
    """As on a cluster: no broadcasts but those that are asked for, and the whole code in sight."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "256k", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_reads_are_not_shuffled_to_their_fragments(spark, small_broadcasts):
    rows = spark.createDataFrame([("chr1", 150, "+")], "chr string, p long, s string")
    got = assign.to_fragment(rows, views.fragments(spark), "chr", "p", ("i", "a", "b"))
    got = assign.to_star(got, views.fragments_2(spark).select("chr", F.col("frag_start").alias("pos")), "chr", "p", "s", "star")
    assert "SortMergeJoin" not in _text(got, "simple")
    assert got.count() == 1


def test_a_position_meets_few_fragments(spark):
    """Fragments a bin, of 200 bases as in the derived tables and of 20,000."""
    for step in (200, 20_000):
        f = spark.range(1000).selectExpr("'chr1' AS chr", "id AS frag_idx", f"id * {step} AS frag_start", f"(id + 1) * {step} - 1 AS frag_end")
        met = assign.owned(f, assign.mean_bin(f, "frag_end")).groupBy("bin").count().agg({"count": "max"}).first()[0]
        assert met <= 4


@pytest.mark.parametrize("name", ["f_separations", "f_filter_counts_re2", "f_size_histogram", "g9_pair_counts"])
def test_the_jvm_compiles_the_filter(spark, small_broadcasts, name):
    """The JVM only compiles methods of up to 8000 bytes; the filter's were longer and so interpreted, row by row."""
    code = _text(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), "codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) <= 8000


@pytest.mark.parametrize("block", [1 << 21, 64])
def test_sums_around_places_are_those_of_all_pairs(monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(5)
    a, b = 1000 + rng.integers(0, 40, 60) * 25, 2000 + rng.integers(0, 40, 60) * 25
    bins = {(i, j): (1000 * (1 + i) + rng.integers(0, 40, 50) * 25, 1000 * (2 + j) + rng.integers(0, 40, 50) * 25, rng.integers(1, 9, 50).astype(float)) for i in (-1, 0, 1) for j in (-1, 0, 1)}
    got = neighbours.sums_around(a, b, bins, 1000, 100)
    want = np.zeros((4, 60))
    for (i, j), (p, o, w) in bins.items():
        for n in range(60):
            x, y = p - a[n], o - b[n]
            near = (x != 0) & (y != 0) if i == j == 0 else (abs(x) < 1000) & (abs(y) < 1000)
            want[0, n] += w[near].sum()
            want[1, n] += w[near].sum() if (i, j) != (0, 0) else 0
            for d in (x, y):
                k = w * neighbours.kernel(d, 1000, 100)
                want[2, n] += k[near & (d < 0)].sum()
                want[3, n] += k[near & (d >= 0)].sum()
    assert np.allclose(got, want, atol=1e-9)


def test_places_are_not_multiplied(spark, small_broadcasts):
    """Each place of a query goes to its bin once; it went to 72 keys."""
    rows = spark.createDataFrame([(1, 0, "chr1", "chr1", 10, 20, 0, 0, 1)], "pair_id long, k long, chr_a string, chr_b string, pos_a long, pos_b long, bin_a long, bin_b long, n long")
    plan = _text(disambiguate.network_scores(rows, rows, queries.PLACE), "simple")
    # the steps of contacts alone
    assert plan.count("Generate explode") <= 3 and "SortMergeJoin" not in plan


def test_sam_lines_are_read_once(spark, small_broadcasts, tmp_path):
    """Each end's file went through two joins, for either mate by itself."""
    for e in (1, 2):
        (tmp_path / f"{e}.sam").write_text(f"@HD\tVN:1.0\n7\t0\tc\t{e}\t255\t2M\t*\t0\t0\tAC\tII\tAS:i:-{e}\n7\t0\tc\t5\t255\t2M\t*\t0\t0\tAC\tII\tAS:i:-9\n@not a header\n")
    a = contacts.read_sam(spark, str(tmp_path / "1.sam"), 1).unionByName(contacts.read_sam(spark, str(tmp_path / "2.sam"), 2))
    got = contacts.sam_pairs(spark.createDataFrame([(7, 1), (8, 0)], "pair_id long, swap_pair long"), a)
    plan = _text(got, "simple")
    assert plan.count("FileScan text") == 2 and "Window" not in plan
    assert [(r.first, r.value.split("\t")[3]) for r in got.orderBy("first").collect()] == [(64, "2"), (128, "1")]
    assert [tuple(r) for r in contacts.sam_header(spark, str(tmp_path / "1.sam")).collect()] == [(0, "@HD\tVN:1.0")]


def test_the_best_alignment_is_that_of_the_order(spark):
    """Scores that are missing come last; then contig and position."""
    schema = "read_no long, end int, flag int, contig string, pos long, seq string, qual string, as_score long, header string"
    rows = [(1, 1, 0, "b", 5, "A", "I", None, "1"), (1, 1, 0, "c", 3, "A", "I", -2, "1"), (1, 1, 0, "a", 9, "A", "I", -2, "1"), (1, 1, 0, "a", 4, "A", "I", -7, "1"), (1, 2, 0, "d", 8, "C", "I", None, "1"), (2, 1, 0, "d", 8, "C", "I", 0, "2")]
    got = contacts.sam_pairs(spark.createDataFrame([(1, 0), (2, 0)], "pair_id long, swap_pair long"), spark.createDataFrame(rows, schema))
    assert sorted(tuple(r.value.split("\t")[2:4]) for r in got.collect()) == [("a", "9"), ("d", "8")]


def test_reads_are_paired_once_and_in_one_shuffle(spark, small_broadcasts):
    """A filter on outcomes unfolded the pairing into itself, and a window and a second shuffle brought reads together again."""
    plan = _text(queries.QUERIES["e8_contact_rows"](spark, "/root/testdata/sf0.001"), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("flatten(") == 1 and "Window" not in plan


def test_ploidy_filters_once(spark, small_broadcasts):
    plan = _text(queries.QUERIES["j3_ploidy"](spark, "/root/testdata/sf0.001"), "simple")
    assert plan.count("FileScan parquet") == 1


def test_a_sample_table_pairs_once(spark, small_broadcasts):
    plan = _text(queries.QUERIES["g14_sample_table_whole"](spark, "/root/testdata/sf0.001"), "simple")
    assert plan.count("flatten(") == 1


def test_star_sizes_measure_once(spark, small_broadcasts):
    got = queries.QUERIES["f12_star_sizes"](spark, "/root/testdata/sf0.001")
    assert _text(got, "simple").count("FileScan parquet") == 1
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", _text(got, "codegen")))) <= 8000


@pytest.mark.parametrize("name", ["g9_pair_counts", "i1_loaded"])
def test_groups_are_brought_together_once(spark, small_broadcasts, name):
    """Before the fragments are looked up, and not again with the wider rows that come of it."""
    plan = _text(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), "simple")
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and "Exchange hashpartitioning(pair_id" not in plan


def test_contacts_to_disambiguate_are_narrow(spark):
    assert len(queries._numbered(spark, "/root/testdata/sf0.001").columns) == 11
