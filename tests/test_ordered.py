"""Numbers and runs over whole orders, genomes in blocks, records from splits: against plain versions."""

import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from contactloom.functions import ordered
from contactloom.operators import barcodes, dedupe, digest
from contactloom.sources import contacts, fastq_source, genome
from test_contacts import CONTACT, contact


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    values = [(f"k{i:04d}", rng.choice(["a", "a", "b", None]), rng.randint(0, 9)) for i in range(500)]
    return spark.createDataFrame(rng.sample(values, 500), "o string, key string, v int"), values


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_numbers_and_runs_do_not_depend_on_ranges(rows, partitions):
    df, values = rows
    got = {r.o: r for r in ordered.equal_runs(df, ["o"], ["key"], partitions).collect()}
    run, total = -1, 0
    sums = {r.o: r.s for r in ordered.running_sums(df, ["o"], {"s": F.col("v")}, partitions).collect()}
    numbers = {r.o: r.n for r in ordered.row_numbers(df, [F.col("o").desc()], "n", 1, partitions).collect()}
    for i, (o, key, v) in enumerate(values):
        run += i == 0 or key != values[i - 1][1]
        total += v
        assert (got[o].row_no, got[o].run_no, sums[o], numbers[o]) == (i, run, total, 500 - i)
    assert {r.n_runs for r in got.values()} == {run + 1}


def test_a_run_may_fill_many_ranges(spark):
    df = spark.createDataFrame([(i, "x" if 10 <= i < 90 else str(i)) for i in range(100)], "o long, key string")
    got = {r.o: r.run_no for r in ordered.equal_runs(df, ["o"], ["key"], 40).collect()}
    assert [got[i] for i in range(100)] == [*range(10), *[10] * 80, *range(11, 21)]
    assert ordered.equal_runs(df.limit(0), ["o"], ["key"], 3).count() == 0


def small_splits(spark, size="512"):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    return lambda: [spark.conf.set(k, v) for k, v in before.items()]


def plain_pieces(seq, site):
    pattern, n = re.compile(site.replace("N", "[AGCT]")), len(site)
    out, at = [], 0
    for m in pattern.finditer(seq):
        out.append((at, m.start()))
        at = m.start() + n
    return [*out, (at, len(seq))]


@pytest.mark.parametrize("site", ["^GATC_", "^AATN_", "C^GCG", "^AA_"])
@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_digest_in_blocks(spark, site, block):
    rng = random.Random(7)
    plain = site.replace("^", "").replace("_", "")
    seqs = ["", "A", plain, plain * 3, "A" * 50, "CG" * 40, "GATC" * 30 + "G", "".join(rng.choice("AACG") for _ in range(400)), "".join(rng.choice("ACGTN") for _ in range(700))]
    df = spark.createDataFrame([(f"c{i}", s) for i, s in enumerate(seqs)], "contig string, seq string")
    got = sorted(map(tuple, digest.fragments(df, site, block=block).collect()))
    want, stars = [], []
    for i, s in enumerate(seqs):
        pieces = plain_pieces(s, plain)
        kept = [p for p in pieces if p[1] > p[0]]
        want += [(f"c{i}", k, a, len(s) - 1 if k == len(kept) - 1 else b + len(plain) - 1) for k, (a, b) in enumerate(kept)]
        stars += [(f"c{i}", a) for a, _ in pieces[:-1]]
    assert got == sorted(want)
    assert sorted(map(tuple, digest.star_sites(df, [site], block=block).collect())) == sorted(stars)


def test_a_site_over_the_border_of_large_blocks(spark):
    seq = "C" * (genome.BLOCK - 2) + "GATC" + "C" * 100
    got = digest.fragments(spark.createDataFrame([("c", seq)], "contig string, seq string"), "^GATC_").orderBy("frag_idx").collect()
    assert [(r.frag_start, r.frag_end) for r in got] == [(0, genome.BLOCK + 1), (genome.BLOCK + 2, len(seq) - 1)]


@pytest.mark.parametrize("block", [30, 64, 1 << 16])
def test_windows_in_blocks(spark, block):
    rng = random.Random(3)
    seq = "NN" + "".join(rng.choice("ACGTN") for _ in range(500)) + "N" * 40
    df = spark.createDataFrame([("c", seq), ("short", "ACGT")], "contig string, seq string")
    got = sorted((r.start, r.end, r.lead, r.tail, r.window) for r in digest.windows(df, 50, 15, block=block).collect())
    want = []
    for s in range(0, len(seq), 15):
        w = seq[s : s + 50]
        x = w.strip("N")
        if len(x) > 18:
            want.append((s, s + len(w), len(w) - len(w.lstrip("N")), len(w.lstrip("N")) - len(x), x))
    assert got == want


def test_fasta_blocks_from_small_splits(spark, tmp_path):
    rng = random.Random(5)
    seqs = {f"c{i}": "".join(rng.choice("acgtN") for _ in range(n)) for i, n in enumerate([3000, 1, 0, 777, 64, 65])}
    text = "stray\n" + "".join(f">{k} x>y\r\n" + "".join(s[i : i + 60] + "\r\n" for i in range(0, len(s), 60)) for k, s in seqs.items())
    (tmp_path / "g.fa").write_text(text)
    undo = small_splits(spark)
    try:
        got = {}
        for r in genome.read_fasta_blocks(spark, str(tmp_path / "g.fa"), 64, 10).collect():
            got[r.contig, r.block] = (r.start, r.bases, bytes(r.seq).decode())
        sizes = {r.contig: r["size"] for r in genome.contig_sizes(spark, str(tmp_path / "g.fa")).collect()}
    finally:
        undo()
    assert got == {(k, b): (b * 64, min(64, len(s) - b * 64), s[b * 64 : b * 64 + 74].upper()) for k, s in seqs.items() for b in range(-(-len(s) // 64))}
    assert sizes == {k: len(s) for k, s in seqs.items()}


@pytest.mark.parametrize("split", [1, 100, 1024, 1 << 20])
def test_fastq_records_from_splits(spark, tmp_path, split):
    rng = random.Random(9)
    reads = []
    for i in range(60):
        n = rng.randint(0, 80)
        # qualities that look like headers and separators
        reads.append((f"@r{i} x", "".join(rng.choice("ACGTN") for _ in range(n)), rng.choice(["+", f"+r{i}"]), ("@+" + "".join(rng.choice("@+I#") for _ in range(n)))[:n]))
    lines = "".join("\n".join(r) + "\n" for r in reads)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.fq").write_text("junk\nmore\n" + lines)
    (tmp_path / "d" / "b.fq").write_bytes(lines.replace("\n", "\r\n").encode() + b"@cut\nACGT\n")
    (tmp_path / "d" / "_c.fq").write_text(lines)
    (tmp_path / "d" / "e.fq").write_text("")
    (tmp_path / "d" / "z.fq.gz").write_bytes(gzip.compress(lines.encode()))
    got = fastq_source.scan_fastq(spark, str(tmp_path / "d"), split)
    assert "Exchange" not in got._jdf.queryExecution().toString()
    found = {}
    for r in got.collect():
        found.setdefault(r.path[-4:], []).append((r.offset, (r.header, r.seq, r.plus, r.qual)))
    assert {k: [x for _, x in sorted(v)] for k, v in found.items()} == {"a.fq": reads, "b.fq": reads, "q.gz": reads}
    # offsets are the headers' first bytes
    assert sorted(found["a.fq"])[1][0] == len("junk\nmore\n") + len("\n".join(reads[0])) + 1
    with pytest.raises(Exception, match="FileNotFound"):
        fastq_source.scan_fastq(spark, str(tmp_path / "none")).count()


def test_group_numbers_go_on_over_splits_and_files(spark, tmp_path):
    rng = random.Random(2)
    codes = ["0.1", *[rng.choice(["1.1", "0.1", "3.0", "0.0"]) for _ in range(300)]]
    line = lambda c: f"chr1 1 2 1 2 + chr2 3 4 3 4 - {c}"
    (tmp_path / "part-0").write_text("\n".join(map(line, codes[:170])) + "\n")
    (tmp_path / "part-1").write_text("\n".join(map(line, codes[170:])) + "\n")
    undo = small_splits(spark)
    try:
        got = contacts.read_ncc_groups(spark, str(tmp_path)).orderBy("line_no").collect()
    finally:
        undo()
    group = 0
    assert [r.line_no for r in got] == list(range(301))
    for r, c in zip(got, codes, strict=True):
        group += c[0] != "0"
        assert (r.group_no, r.marker, r.active) == (group, int(c[0]), c.endswith("1"))


LINES = dedupe.DedupeSettings(adjacent_only=True, min_repeats=1)


def test_a_pair_that_only_loses_to_itself_stays(spark):
    # lines go by the text of start_a: 1000, 1000, 10050 (another end), 2000, 2000
    one = [contact(1, ("chr1", 1000), ("chr2", 5000), 2), contact(1, ("chr1", 1000), ("chr2", 5000), 2, 71)]
    other = [contact(3, ("chr1", 10050), ("chr3", 5000))]
    later = [contact(2, ("chr1", 2000), ("chr2", 5000)), contact(4, ("chr1", 2000), ("chr2", 5000), 2), contact(9, ("chr9", 1), ("chr9", 7000))]
    same = [(*r[:4], 900, 1400, *r[6:]) if r[0] in (1, 2, 4) else r for r in one + other + later]  # all with one fragment end
    df = spark.createDataFrame(same, CONTACT)
    kept = {r.pair_id: r.repeats for r in dedupe.dedupe(df, LINES).collect()}
    assert kept == {1: 2, 2: 2, 3: 1}  # 4 lost to 2; the last run (9) counts no repeats
    assert dedupe.dedupe_stats(df, LINES).first().redundant == 1
    assert set(dedupe.winners(df).filter("winner").select("pair_id").toPandas()["pair_id"]) == {2, 3, 9}


@pytest.mark.parametrize("partitions", [1, 3, 200])
def test_line_runs_do_not_depend_on_ranges(spark, partitions):
    rng = random.Random(6)
    data = [contact(i, (f"chr{rng.choice([1, 10, 2])}", rng.choice([100, 1000, 200])), ("chr2", rng.choice([5, 50])), rng.randint(1, 2), rng.randint(60, 62)) for i in range(300)]
    got = {r.pair_id: (r.winner, r.run) for r in dedupe.winners(spark.createDataFrame(data, CONTACT), LINES, partitions).collect()}
    names = CONTACT.replace(" long", "").replace(" string", "").split(", ")
    rows = [dict(zip(names, r, strict=True)) for r in data]
    lines = sorted(rows, key=lambda r: " ".join(str(r[c]) for c in dedupe.TEXT).encode())
    runs = []
    for i, r in enumerate(lines):
        key = [r[c] for c in dedupe.keys(LINES)]
        if not runs or runs[-1][0] != key:
            runs.append((key, []))
        runs[-1][1].append((r["ambig_size"], -(abs(r["end_a"] - r["start_a"]) if i else 0) - abs(r["end_b"] - r["start_b"]), i, r["pair_id"]))
    assert got == {row[-1]: (row == min(run), len(run)) for _, run in runs for row in run}


def test_regions_that_hold_others(spark, tmp_path):
    rng = random.Random(8)
    regions = [("c1", 0, 50_000_000), ("c1", 60_000_000, 60_000_010), ("c2", 16_380, 16_390), ("c2", 16_384, 16_384), ("c2", 0, 1 << 40)]
    regions += [("c3", s, s + rng.choice([0, 10, 5000, 200_000])) for s in (rng.randrange(3_000_000) for _ in range(200))]
    (tmp_path / "r.bed").write_text("# x\n" + "".join(f"{c}\t{a}\t{b}\n" for c, a, b in regions))
    points = [("c1", p) for p in (0, 49_999_999, 50_000_000, 50_000_001, 60_000_005)] + [("c2", 5), ("c4", 1), ("c3", None), (None, 3)] + [("c3", rng.randrange(3_300_000)) for _ in range(400)]
    marked = genome.regions(spark, str(tmp_path / "r.bed"))
    assert marked.count() == len(regions)
    df = spark.createDataFrame(points * 2, "chr string, pos long")
    got = sorted(map(tuple, genome.in_regions(df, marked, "chr", "pos").collect()), key=str)
    inside = lambda c, p: any(r[0] == c and p is not None and r[1] <= p <= r[2] for r in regions)
    assert got == sorted([(c, p, inside(c, p)) for c, p in points * 2], key=str)


@pytest.mark.parametrize("mismatches", [0, 1, 2, 3])
def test_near_codes(spark, mismatches):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    valid = [make(rng.choice([5, 8, 9])) for _ in range(30)] + ["A", ""]
    seen = [make(rng.choice([1, 5, 8, 9])) for _ in range(60)] + valid[:5]
    for v in valid[:20]:
        s = list(v)
        for i in rng.sample(range(len(s)), min(len(s), 2)):
            s[i] = rng.choice("ACGTN")
        seen.append("".join(s))
    frame = lambda codes: spark.createDataFrame([(c,) for c in codes], "code string")
    got = {(r.code, r.match, r.distance) for r in barcodes.near_codes(frame(seen), frame(valid), mismatches).filter("code <> ''").collect()}
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    assert got == {(a, b, far(a, b)) for a in seen for b in valid if a and len(a) == len(b) and far(a, b) <= mismatches}


def test_near_code_candidates_are_few(spark):
    rng = random.Random(11)
    codes = list({"".join(rng.choice("ACGT") for _ in range(16)) for _ in range(2000)})
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    piece = df.select("code", F.explode(barcodes.segments(F.col("code"), 2)).alias("x"))
    pairs = piece.alias("a").join(piece.alias("b"), "x").count()
    assert pairs < 20_000  # of 4 million; 6,000 are codes with themselves


def test_sample_numbers(spark):
    counts = spark.createDataFrame([(f"c{i}", i % 7, 0.0) for i in range(100)], "code string, n long, percent double")
    valid = spark.createDataFrame([("c5", "named")], "code string, sample string")
    got = {r.code: r.sample for r in barcodes.name_samples(counts, valid, 9).collect()}
    order = sorted((f"c{i}" for i in range(100) if i != 5), key=lambda c: (int(c[1:]) % 7, c), reverse=True)
    assert got == {"c5": "named"} | {c: f"sample_{k + 1}" for k, c in enumerate(order)}
