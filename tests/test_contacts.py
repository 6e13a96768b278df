"""Hand-worked cases, round trips, conservation laws, and SQL twins on the smallest tables."""

import glob
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from contactloom.functions import files, sites
from contactloom.operators import assign, barcodes, classify, clip, contact_stats, dedupe, digest, disambiguate, promiscuity
from contactloom.plans import contact_pipeline, queries
from contactloom.plans.config import PipelineConfig
from contactloom.sources import contacts as nccio
from contactloom.sources import fastq, genome, stats_io

SF = "/root/testdata/sf0.001"


def test_sites():
    assert [sites.junction(s) for s in ("^GATC_", "A^GATC_T", "A^AGCT_T", "AG^CT")] == ["GATCGATC", "AGATCGATCT", "AAGCTAGCTT", "AGCT"]
    for bad in ("GATC", "^^GATC", "^GA_T_C", "^GAXC"):
        with pytest.raises(sites.SiteError):
            sites.check_site(bad)
    assert sites.parse_sizes("150-1500") == (150, 1500) and sites.parse_sizes("200") == (200, 1e16)


def test_file_pairs():
    assert files.pair_files(["d/a_r_1.fq", "d/a_r_2.fq"]) == [("d/a_r_1.fq", "d/a_r_2.fq")]
    for bad in (["a_r_1.fq"], ["a.fq", "b.fq"], ["a_r_1.fq", "a_r_1.fq"]):
        with pytest.raises(files.FileError):
            files.pair_files(bad)
    assert files.tagged("x/a.fq.gz", "clip") == "x/a_clip.fq.gz" and files.merged_root("a_1.fq", "a_2.fq") == "a_1_2"


def test_digest(spark):
    df = spark.createDataFrame([("a", "AAGATCGATCTT"), ("b", "GATCAAGATC"), ("c", "AATT")], "contig string, seq string")
    got = {c: [] for c in "abc"}
    for r in digest.fragments(df, "^GATC_").orderBy("contig", "frag_idx").collect():
        got[r.contig].append((r.frag_start, r.frag_end))
    assert got == {"a": [(0, 5), (10, 11)], "b": [(4, 9)], "c": [(0, 3)]}


def test_clip(spark):
    body = "ACGTACGTACGTACGTAC"
    rows = [(1, body + "GATCGATC" + "TTTT", "I" * 30), (2, body + "GT" + "NN", "I" * 22), (3, body + "GT", "IIIII#" + "I" * 14), (4, body[:17], "I" * 17)]
    s = clip.ClipSettings("GATCGATC", "GATC")
    done = clip.clip_all(spark.createDataFrame(rows, "read_no long, seq string, qual string"), s)
    got = {r.read_no: r for r in done.collect()}
    assert got[1].seq == body + "GATC" and got[1].junction_at == 18
    assert len(got[2].seq) == 20 and got[2].clipped_quality and not got[3].clipped_quality
    assert got[3].seq[5] == "N" and got[4].too_short
    st = clip.clip_stats(done).first()
    assert (st.input_reads, st.junction, st.quality, st.short, st.mean_length) == (4, 1, 1, 1, 15.5)


@pytest.mark.parametrize(("tail", "cut"), [("AGATCGGAA", True), ("AGATCGGTAGAGC", True), ("AGATCGGTTGAGC", False)])
def test_adapter(spark, tail, cut):
    df = spark.createDataFrame([(1, "C" * 20 + tail, "I" * (20 + len(tail)))], "read_no long, seq string, qual string")
    got = clip.clip_all(df, clip.ClipSettings("GATCGATC", "GATC")).first()
    assert len(got.seq) == (20 if cut else 20 + len(tail))


@pytest.mark.parametrize(("quals", "want"), [(["!", "I"], "phred33"), ([";", "h"], "solexa"), (["@", "h"], "phred64"), (["<", "F"], "phred33")])
def test_quality_scheme(spark, quals, want):
    assert clip.quality_scheme(spark.createDataFrame([("".join(quals),)], "qual string")).first().scheme == want


def frags(spark, spans, chrom="c1"):
    return spark.createDataFrame([(chrom, i, a, b) for i, (a, b) in enumerate(spans)], "chr string, frag_idx long, frag_start long, frag_end long")


def test_asof(spark):
    rows = spark.createDataFrame([("c1", p) for p in (9, 10, 22, 99)] + [("no", 1)], "chr string, pos long")
    got = {(r.chr, r.pos): r.i for r in assign.to_fragment(rows, frags(spark, [(0, 9), (10, 19), (24, 40)]), "chr", "pos", ("i", "s", "e")).collect()}
    assert got == {("c1", 9): 0, ("c1", 10): 1, ("c1", 22): 2, ("c1", 99): 2, ("no", 1): None}


PAIR = "pair_id long, chr_a string, start_a long, end_a long, strand_a string, chr_b string, start_b long, end_b long, strand_b string, ambig_size long"


@pytest.mark.parametrize(
    ("a", "b", "width", "tag"),
    [
        ((100, 170, "+"), (900, 830, "-"), 1000, "internal_re1"),
        ((170, 100, "-"), (830, 900, "+"), 1000, "circular_re1"),
        ((950, 1020, "+"), (1500, 1430, "-"), 1000, "overhang_re1"),
        ((900, 970, "+"), (1500, 1430, "-"), 1000, "adjacent_re1"),
        ((900, 970, "+"), (2150, 2080, "-"), 1000, "accepted"),
        ((10, 80, "+"), (5990, 5920, "-"), 1000, "too_big"),
        ((50, 90, "+"), (350, 310, "-"), 100, "too_close"),
    ],
)
def test_classify(spark, a, b, width, tag):
    df = spark.createDataFrame([(1, "c1", *a, "c1", *b, 2), (1, "zz", *a, "c1", *b, 2)], PAIR)
    got = classify.classify(df, frags(spark, [(i * width, i * width + width - 1) for i in range(10)]), classify.FilterSettings(150, 1500))
    assert {r.chr_a: r.tag for r in got.collect()} == {"c1": tag, "zz": "unknown_contig"}
    if tag == "accepted":
        assert "excluded_group" in {r.tag for r in classify.drop_groups(got).collect()}


CONTACT = "pair_id long, chr_a string, start_a long, end_a long, f_start_a long, f_end_a long, strand_a string, chr_b string, start_b long, end_b long, f_start_b long, f_end_b long, strand_b string, ambig_size long"


def contact(i, a, b, ambig=1, size=70):
    return (i, a[0], a[1], a[1] + size, a[1], a[1] + 500, "+", b[0], b[1], b[1] + 70, b[1], b[1] + 500, "+", ambig)


def test_dedupe(spark):
    rows = [contact(i, ("chr1", 1000), ("chr2", 5000), 1, n) for i, n in ((1, 70), (2, 72), (3, 71))] + [contact(4, ("chr1", 9000), ("chr2", 5000))]
    df = spark.createDataFrame(rows, CONTACT)
    got = dedupe.dedupe(df).collect()
    assert [(r.pair_id, r.repeats) for r in got] == [(2, 3)]
    population = dedupe.dedupe(df, dedupe.DedupeSettings(population=True)).collect()
    assert {(r.pair_id, r.supported) for r in population} >= {(4, False)}
    two = spark.createDataFrame([contact(1, ("chr1", 1), ("chr2", 5), 1), contact(2, ("chr1", 1), ("chr2", 5), 2, 80)], CONTACT)
    assert {r.pair_id for r in dedupe.winners(two).filter("winner").collect()} == {1}
    assert {r.pair_id for r in dedupe.winners(two, dedupe.DedupeSettings(hybrid=True)).filter("winner").collect()} == {2}


@pytest.mark.parametrize(
    ("others", "want"),
    [
        ([("chr2", 5000), ("chr2", 5500)], "clean"),
        ([("chr2", 5000), ("chr2", 5500), ("chr2", 5900)], "resolved"),
        ([("chr2", 5000), ("chr2", 5500), ("chr3", 100)], "promiscuous"),
        ([("chr2", 5000), ("chr3", 1), ("chr4", 1), ("chr5", 1)], "promiscuous"),
        ([("chr1", 3000), ("chr1", 3400), ("chr1", 3900)], "promiscuous"),
    ],
)
def test_promiscuous(spark, others, want):
    df = spark.createDataFrame([contact(i, ("chr1", 1000), o) for i, o in enumerate(others)], CONTACT)
    assert {r.promiscuity for r in promiscuity.mark_promiscuous(df, 2).collect()} == {want}


def test_contact_stats(spark):
    rows = [contact(1, ("chr1", 1000), ("chr1", 1500)), contact(2, ("chr1", 1), ("chr1", 50_001), 2), contact(2, ("chr1", 1), ("chr2", 1), 2)]
    r = contact_stats.contact_stats(spark.createDataFrame(rows, CONTACT)).first()
    assert (r.total_contacts, r.ambig_contacts, r.total_pairs, r.mean_ambiguity, r.cis_near, r.cis_far, r.trans) == (2, 1, 3, 2.0, 1, 0, 1)


def test_network_score(spark):
    s = disambiguate.DisambiguateSettings(separation=1_000_000)
    cols = "pair_id long, k long, chr_a string, chr_b string, pos_a long, pos_b long, bin_a long, bin_b long, n long"
    q = spark.createDataFrame([(1, 0, "a", "a", 2_400_000, 2_600_000, 2, 2, 2), (2, 0, "a", "a", 2_900_000, 2_600_000, 2, 2, 2)], cols)
    o = spark.createDataFrame([(9, 0, "a", "a", 2_900_000, 2_100_000, 2, 2, 1)], cols)
    got = {r.pos_a: r.score for r in disambiguate.network_scores(q, o, s).collect()}
    assert abs(got[2_400_000] - 0.272096) < 1e-6 and 2_900_000 not in got


def test_barcodes(spark):
    reads = spark.createDataFrame([(i, c) for i, c in enumerate(["ACGT", "TTTA", "ACGC", "GGGG"])], "read_no long, code string")
    valid = spark.createDataFrame([("ACGT", "x"), ("ACGA", "y"), ("TTTT", "z")], "code string, sample string")
    got = {r.code: (r.match, r.valid) for r in barcodes.demultiplex(reads, valid, 1).collect()}
    assert got == {"ACGT": ("ACGT", True), "TTTA": ("TTTT", True), "ACGC": (None, False), "GGGG": (None, False)}


def test_splice(spark):
    cols = "read_no long, header string, seq string, qual string"
    a = spark.createDataFrame([(0, "@r1 1", "AC", "II")], cols)
    b = spark.createDataFrame([(0, "@r1 2", "GT", "##")], cols)
    r = barcodes.splice(a, b).first()
    assert (r.header, r.seq, r.plus, r.qual) == ("@r1 1", "ACGT", "+", "II##")
    with pytest.raises(Exception, match="reads differ"):
        barcodes.splice(a, spark.createDataFrame([(0, "@r2 2", "GT", "##")], cols)).collect()


@pytest.mark.parametrize("compressed", [False, True])
def test_fastq_round_trip(spark, tmp_path, compressed):
    reads = spark.createDataFrame([(i, f"@r{i}", "ACGT" * 5, "+", "@@II" * 5) for i in range(50)], "read_no long, header string, seq string, plus string, qual string")
    path = str(tmp_path / "fq")
    fastq.fastq_text(reads.orderBy("read_no").coalesce(1)).write.option("compression", "gzip" if compressed else "none").text(path)
    got = fastq.read_fastq(spark, path, 1).select(*reads.columns)
    assert sorted(got.collect()) == sorted(reads.collect())
    assert fastq.validate_fastq(fastq.numbered_lines(spark, path)).count() == 0


def test_fasta_and_names(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">c1 first\nacgt\nAC\n>c2\nGG\n")
    assert {(r.contig, r.seq) for r in genome.read_fasta(spark, str(tmp_path / "g.fa")).collect()} == {("c1", "ACGTAC"), ("c2", "GG")}
    assert {(r.contig, r["size"]) for r in genome.contig_sizes(spark, str(tmp_path / "g.fa")).collect()} == {("c1", 6), ("c2", 2)}
    (tmp_path / "n.txt").write_text("# c\nc1 chr1\nc2 chr2\n")
    names = genome.read_names(spark, str(tmp_path / "n.txt"))
    both, partners = genome.homologs(names, names)
    assert {r.chr for r in both.collect()} == {"chr1.a", "chr2.a", "chr1.b", "chr2.b"} and partners.count() == 4


def test_ncc_round_trip(spark, tmp_path):
    rows = [("chr1", 1, 71, 0, 500, "+", "chr2", 5, 75, 0, 400, "-", "2.1", 7, 0), ("chr1", 1, 71, 0, 500, "+", "chr3", 5, 75, 0, 400, "-", "0.0", 7, 1), ("chr1", 9, 71, 0, 500, "+", "chr3", 5, 75, 0, 400, "-", "1.1", 8, 0)]
    text = "\n".join(" ".join(map(str, r)) for r in rows) + "\n"
    (tmp_path / "x.ncc").write_text(text)
    df = nccio.read_ncc(spark, str(tmp_path / "x.ncc"))
    assert sorted(r.value for r in nccio.ncc_text(df).collect()) == sorted(text.splitlines())
    nccio.write_ncc(df, str(tmp_path / "out"))
    assert sorted(nccio.read_ncc(spark, str(tmp_path / "out")).collect(), key=str) == sorted(df.collect(), key=str)


def test_sam_pipeline(spark, tmp_path):
    line = lambda i, flag, c, pos: f"{i:010d}_r\t{flag}\t{c}\t{pos}\t255\t50M\t*\t0\t0\t{'A' * 50}\t{'I' * 50}\tAS:i:0\tXX:i:1\tMD:Z:50"
    (tmp_path / "1.sam").write_text("@SQ\n" + line(1, 0, "c1", 1600) + "\n" + line(2, 4, "*", 0) + "\n")
    (tmp_path / "2.sam").write_text(line(1, 16, "c1", 5200) + "\n" + line(2, 0, "c1", 9) + "\n")
    al = nccio.read_sam(spark, str(tmp_path / "1.sam"), 1).unionByName(nccio.read_sam(spark, str(tmp_path / "2.sam"), 2))
    cfg = PipelineConfig(min_repeats=1)
    got = contact_pipeline.filtered_contacts(al, frags(spark, [(i * 1000, i * 1000 + 999) for i in range(10)]), cfg)
    (r,) = got.collect()
    assert (r.pair_id, r.tag, r.start_b, r.end_b) == (1, "accepted", 5250, 5200)
    assert contact_pipeline.final_contacts(got, cfg).count() == 1
    sam = nccio.sam_pairs(got, al).collect()
    assert sorted(int(x.value.split("\t")[1]) for x in sam) == [99, 147] and len(sam) == 2


def test_stats_file(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, "n", 5.0), ("a", 1, "m", 2.5)], "section string, ord int, key string, value double")
    stats_io.write_stats(df, str(tmp_path / "s.json"))
    assert {(r.key, r.value) for r in stats_io.read_stats(spark, str(tmp_path / "s.json")).collect()} == {("n", 5.0), ("m", 2.5)}
    assert stats_io.format_value(1234, 2468) == "1,234 (50.00 %)"


def test_conservation(spark):
    tagged = queries._tagged(spark, SF)
    n = tagged.count()
    counts = {r.tag: r.n for r in classify.filter_counts(tagged).collect()}
    assert sum(counts.values()) == n
    assert sum(r.n for r in classify.separations(tagged).collect()) == counts["accepted"] + counts["excluded_group"]
    d = queries.g2_dedupe_stats(spark, SF).first()
    assert d.unique_reads + d.supported == d.effective and d.redundant + d.effective == d.input_reads
    s = queries.g5_contact_stats(spark, SF).first()
    assert s.cis_near + s.cis_far + s.trans + s.homolog_trans == s.total_contacts


def test_homologs_beyond_a_million_rows(spark):
    homologs = spark.range(0, 1_000_001, 1, 1).select(F.concat(F.lit("a"), "id").alias("chr"), F.concat(F.lit("b"), "id").alias("partner"))
    row = (1, "a1000000", "b1000000", "+", "+", 0, 0, 9, 9)
    df = spark.createDataFrame([row], "pair_id long, chr_a string, chr_b string, strand_a string, strand_b string, f_start_a long, f_start_b long, f_end_a long, f_end_b long")
    assert contact_stats.group_classes(df, homologs).first().code == 3


@pytest.mark.parametrize("name", ["f_filter_counts", "c4_asof_fragment", "g1_dedupe", "g4_promiscuity_stats", "b10_clip_stats", "d1_fragments", "e9_pair_stats", "c16_demultiplex", "j2_contact_probability"])
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got = queries.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    a = sorted(map(repr, (tuple(None if v is None else float(v) if isinstance(v, (int, float)) else v for v in r) for r in got.select(*[F.col(f"`{c}`") for c in cols]).collect())))
    rows = con.sql(queries.ORACLE[name]).project(", ".join(f'"{c}"' for c in cols)).fetchall()
    b = sorted(map(repr, (tuple(None if v is None else float(v) if isinstance(v, (int, float)) else v for v in r) for r in rows)))
    assert a == b


def test_only_line_starts_begin_fasta_entries(spark, tmp_path):
    (tmp_path / "a.fa").write_text("; a remark\n>c1 a>b note\nACg\nTT\n>c2\r\nNN>N\n>c3\n")
    got = {r.contig: r.seq for r in genome.read_fasta(spark, str(tmp_path / "a.fa")).collect()}
    assert got == {"c1": "ACGTT", "c2": "NN>N", "c3": ""}


def test_fragment_files_come_back_whole(spark, tmp_path):
    rows = [("chr1", k, k * 100, k * 100 + 99) for k in range(10)]
    df = spark.createDataFrame(rows, "chr string, frag_idx long, frag_start long, frag_end long")
    genome.fragments_text(df.repartition(2)).write.text(str(tmp_path / "f"))
    (tmp_path / "f" / "head.txt").write_text("Source\tContig\tFrag_Start\tFrag_End\tMappability\n")
    back = genome.read_fragments_text(spark, str(tmp_path / "f"))
    assert sorted(map(tuple, back.select("chr", "frag_idx", "frag_start", "frag_end").collect())) == rows


def test_bad_fastq_lines_are_told(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@a\nAC\n+\nII\nb\nAC\n-\nII\n")
    bad = fastq.validate_fastq(fastq.numbered_lines(spark, str(tmp_path / "a.fq")))
    assert sorted((r.line_no, r.value) for r in bad.collect()) == [(4, "b"), (6, "-")]


def test_stats_without_contacts_are_an_error(spark):
    ncc, stats = (spark.createDataFrame([(x,)], "path string") for x in ("a/x.ncc", "a/y_stats.json"))
    with pytest.raises(ValueError, match="without contacts"):
        contact_stats.join_by_root(ncc, stats)


def test_the_text_operators_can_be_taken_away(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'f_filter_counts' in q and set(o) == set(q), set(q) ^ set(o); assert not any(n.startswith('op') or n == 'pipeline' for n in q)"
    for gone in ((), ("corpus_pipeline.py",)):
        for name in gone:
            (tmp_path / "repo" / name).unlink()
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env={**os.environ, "PYTHONPATH": ""})


def test_streams_are_clipped(spark, tmp_path):
    from contactloom.streaming import reads as streams

    s = clip.ClipSettings("GATCGATC", "GATC", min_length=4)
    spark.createDataFrame([(1, "ACGTGATCGATCAA", "I" * 14), (2, "AC", "II")], "read_no long, seq string, qual string").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("read_no long, seq string, qual string").parquet(str(tmp_path / "in"))
    query = streams.clip_stream(source, s).writeStream.format("memory").queryName("clipped").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [tuple(r) for r in spark.sql("select * from clipped").collect()] == [(1, "ACGTGATC", "I" * 8)]
