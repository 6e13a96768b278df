"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from contactloom.plans import views

V, FR, FR2 = views.plain(views.CONTACTS), views.FRAGMENTS["duckdb"], views.FRAGMENTS_2["duckdb"]


def _asof(source: str, frag: str, x: str, prefix: str) -> str:
    """source with the first fragment that ends at or after end_x, else the chromosome's last one."""
    return f"""(SELECT s.*, coalesce(f.frag_idx, l.frag_idx) AS {prefix}idx_{x}, coalesce(f.frag_start, l.frag_start) AS {prefix}f_start_{x}, coalesce(f.frag_end, l.frag_end) AS {prefix}f_end_{x}
 FROM {source} s ASOF LEFT JOIN {frag} f ON s.chr_{x} = f.chr AND s.end_{x} <= f.frag_end
 LEFT JOIN (SELECT chr, max(frag_idx) AS frag_idx, arg_max(frag_start, frag_end) AS frag_start, max(frag_end) AS frag_end FROM {frag} GROUP BY chr) l ON s.chr_{x} = l.chr)"""


def _tagged(lo: int = 200, hi: int = 450, close: int = 325, re2: bool = False) -> str:
    """CTEs up to t: every contact with size, tag and separation."""
    base = _asof(_asof("v", "fr", "a", ""), "fr", "b", "")
    if re2:
        base = _asof(_asof(base, "fr2", "a", "r_"), "fr2", "b", "r_")
    second = (
        """WHEN chr_a = chr_b AND r_idx_a = r_idx_b AND idx_a = idx_b THEN 'internal_re2'
   WHEN abs(CASE WHEN strand_a = '+' THEN start_a - r_f_start_a ELSE r_f_end_a - start_a END) > 1000
     OR abs(CASE WHEN strand_b = '+' THEN start_b - r_f_start_b ELSE r_f_end_b - start_b END) > 1000 THEN 'no_end_re2'"""
        if re2
        else ""
    )
    missing = "idx_a IS NULL OR idx_b IS NULL" + (" OR r_idx_a IS NULL OR r_idx_b IS NULL" if re2 else "")
    return f"""v AS ({V}), fr AS ({FR}), fr2 AS ({FR2}),
m AS (SELECT *, greatest(0, CASE WHEN strand_a = '+' THEN f_end_a - start_a ELSE start_a - f_start_a END) AS da,
   greatest(0, CASE WHEN strand_b = '+' THEN f_end_b - start_b ELSE start_b - f_start_b END) AS db,
   CASE WHEN strand_a = '+' THEN start_a ELSE end_a END AS p1, CASE WHEN strand_a = '+' THEN end_a ELSE start_a END AS p2,
   CASE WHEN strand_b = '+' THEN start_b ELSE end_b END AS p3, CASE WHEN strand_b = '+' THEN end_b ELSE start_b END AS p4 FROM {base} q),
n AS (SELECT *, da + db AS size, CASE WHEN strand_a = '+' AND strand_b = '-' AND p1 < p3 THEN p4 - p1 WHEN strand_b = '+' AND strand_a = '-' AND p3 < p1 THEN p2 - p3 END AS span FROM m),
t0 AS (SELECT *, CASE WHEN {missing} THEN 'unknown_contig' {second}
   WHEN chr_a = chr_b AND idx_a = idx_b AND ((start_a < start_b AND strand_b = '+' AND strand_a = '-') OR (start_a >= start_b AND strand_a = '+' AND strand_b = '-')) THEN 'circular_re1'
   WHEN chr_a = chr_b AND idx_a = idx_b AND ((p1 < f_start_a AND f_start_a < p2) OR (p1 < f_end_a AND f_end_a < p2) OR (p3 < f_start_b AND f_start_b < p4) OR (p3 < f_end_b AND f_end_b < p4)) THEN 'overhang_re1'
   WHEN chr_a = chr_b AND idx_a = idx_b THEN 'internal_re1'
   WHEN chr_a = chr_b AND abs(idx_a - idx_b) < 2 THEN 'adjacent_re1'
   WHEN chr_a = chr_b AND span < 1 THEN 'no_insert' WHEN chr_a = chr_b AND span < {close} THEN 'too_close'
   WHEN size < {lo} THEN 'too_small' WHEN size > {hi} THEN 'too_big' ELSE 'accepted' END AS tag0 FROM n),
t AS (SELECT *, CASE WHEN tag0 = 'accepted' AND max(tag0 <> 'accepted') OVER (PARTITION BY pair_id) THEN 'excluded_group' ELSE tag0 END AS tag,
   CASE WHEN tag0 <> 'accepted' THEN NULL WHEN chr_a <> chr_b THEN 'trans' WHEN least(abs(p1 - p3), abs(p2 - p4)) < 10000 THEN 'near' ELSE 'far' END AS separation FROM t0),
acc AS (SELECT * FROM t WHERE tag = 'accepted')"""


T = _tagged()
COUNTS = "SELECT tag, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM t GROUP BY tag"
HISTOGRAM = """h AS (SELECT series, bin, count(*) AS n FROM (SELECT cast(floor(10 * log10(greatest(size, 1))) AS bigint) AS bin,
 unnest(CASE WHEN tag <> 'accepted' THEN ['all'] WHEN chr_a = chr_b THEN ['all', 'cis'] ELSE ['all', 'trans'] END) AS series FROM t WHERE tag <> 'unknown_contig') GROUP BY 1, 2)"""
RUNS = """w AS (SELECT *, row_number() OVER (PARTITION BY chr_a, f_start_a, strand_a, chr_b, f_start_b, strand_b
  ORDER BY ambig_size, abs(end_a - start_a) + abs(end_b - start_b) DESC, start_a, end_a, start_b, end_b, pair_id) AS r,
  count(*) OVER (PARTITION BY chr_a, f_start_a, strand_a, chr_b, f_start_b, strand_b) AS run FROM acc),
lost AS (SELECT DISTINCT x.pair_id FROM w x JOIN w y ON (x.chr_a, x.f_start_a, x.strand_a, x.chr_b, x.f_start_b, x.strand_b) = (y.chr_a, y.f_start_a, y.strand_a, y.chr_b, y.f_start_b, y.strand_b)
  WHERE y.r = 1 AND x.pair_id <> y.pair_id),
reps AS (SELECT pair_id, sum(CASE WHEN r = 1 THEN run ELSE 0 END) AS repeats, max(ambig_size) AS places FROM w GROUP BY pair_id)"""
#: The same by read starts, the most ambiguous first.
RUNS_2 = RUNS.replace("f_start_", "start_").replace("ORDER BY ambig_size,", "ORDER BY ambig_size DESC,")
ENDS = """e AS (SELECT DISTINCT * FROM (SELECT chr_a AS c, f_start_a AS p, strand_a AS s, chr_b AS oc, f_start_b AS op, strand_b AS os, pair_id FROM acc
  UNION ALL SELECT chr_b, f_start_b, strand_b, chr_a, f_start_a, strand_a, pair_id FROM acc)),
b AS (SELECT c, p, s, count(*) AS n_ends, count(DISTINCT pair_id) AS n_groups FROM e GROUP BY 1, 2, 3 HAVING count(*) > 2 AND count(DISTINCT pair_id) > 2),
g AS (SELECT x.c, x.p, x.s, (x.oc = y.oc AND abs(x.op - y.op) < 1000) AND (x.c <> x.oc OR (abs(x.p - x.op) > 10000 AND abs(x.p - y.op) > 10000)) AS good
  FROM e x JOIN e y ON x.c = y.c AND x.p = y.p AND x.s = y.s AND (x.oc, x.op, x.os, x.pair_id) < (y.oc, y.op, y.os, y.pair_id)
  JOIN b ON b.c = x.c AND b.p = x.p AND b.s = x.s WHERE n_ends = 3),
ends AS (SELECT b.*, coalesce(q.remove, true) AS remove, coalesce(q.resolve, false) AS resolve FROM b LEFT JOIN (SELECT c, p, s, bool_or(NOT good) AS remove, bool_or(good) AS resolve FROM g GROUP BY 1, 2, 3) q USING (c, p, s))"""
POS = """pos AS (SELECT *, CASE WHEN strand_a = '+' THEN f_end_a ELSE f_start_a END AS pos_a, CASE WHEN strand_b = '+' THEN f_end_b ELSE f_start_b END AS pos_b FROM acc),
lim AS (SELECT chr, min(p) AS lo, max(p) AS hi FROM (SELECT chr_a AS chr, pos_a AS p FROM pos UNION ALL SELECT chr_b, pos_b FROM pos) GROUP BY chr)"""
LOADED = (
    POS
    + """, h0 AS (SELECT *, CASE chr_a WHEN 'chr3' THEN 'chr1.b' WHEN 'chr1' THEN 'chr1.a' ELSE chr_a END AS ca, CASE chr_b WHEN 'chr3' THEN 'chr1.b' WHEN 'chr1' THEN 'chr1.a' ELSE chr_b END AS cb FROM pos),
h1 AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY start_a, start_b, strand_a, strand_b, ca, cb) - 1 AS k FROM h0),
ld AS (SELECT pair_id, k, least(ca, cb) AS chr_a, greatest(ca, cb) AS chr_b, CASE WHEN ca > cb THEN pos_b ELSE pos_a END AS pos_a, CASE WHEN ca > cb THEN pos_a ELSE pos_b END AS pos_b,
  count(*) OVER (PARTITION BY pair_id) AS n FROM h1),
lb AS (SELECT pair_id, k, chr_a, chr_b, pos_a, pos_b, cast(floor(pos_a / 50000) AS bigint) AS bin_a, cast(floor(pos_b / 50000) AS bigint) AS bin_b, n FROM ld)"""
)
KERNEL = lambda d: f"exp(-pow(greatest(abs({d}), 100) / 25000.0, 2))"
SCORES = f"""q AS (SELECT DISTINCT chr_a, chr_b, pos_a, pos_b, bin_a, bin_b FROM lb), o AS (SELECT * FROM lb WHERE n = 1),
d AS (SELECT q.*, o.pos_a - q.pos_a AS d1, o.pos_b - q.pos_b AS d2, q.bin_a = o.bin_a AND q.bin_b = o.bin_b AS own
  FROM q JOIN o ON q.chr_a = o.chr_a AND q.chr_b = o.chr_b AND abs(q.bin_a - o.bin_a) <= 1 AND abs(q.bin_b - o.bin_b) <= 1),
sc AS (SELECT chr_a, chr_b, pos_a, pos_b, round(least(8.0, log10((1 + sum(CASE WHEN d1 < 0 THEN {KERNEL("d1")} ELSE 0 END + CASE WHEN d2 < 0 THEN {KERNEL("d2")} ELSE 0 END))
  * (1 + sum(CASE WHEN d1 >= 0 THEN {KERNEL("d1")} ELSE 0 END + CASE WHEN d2 >= 0 THEN {KERNEL("d2")} ELSE 0 END)))), 9) AS score
  FROM d WHERE CASE WHEN own THEN d1 <> 0 AND d2 <> 0 ELSE abs(d1) < 50000 AND abs(d2) < 50000 END GROUP BY 1, 2, 3, 4)"""
DENSE = """own AS (SELECT chr_a, chr_b, bin_a, bin_b, count(*) AS c FROM lb WHERE split_part(chr_a, '.', 1) = split_part(chr_b, '.', 1) GROUP BY 1, 2, 3, 4),
lm AS (SELECT quantile_cont(c, 0.9) AS limit_ FROM own),
ar AS (SELECT x.pair_id, x.k, count(*) AS around FROM lb x JOIN lb y ON x.chr_a = y.chr_a AND x.chr_b = y.chr_b AND abs(x.bin_a - y.bin_a) <= 1 AND abs(x.bin_b - y.bin_b) <= 1
  WHERE x.chr_a <> x.chr_b AND split_part(x.chr_a, '.', 1) = split_part(x.chr_b, '.', 1) AND NOT (x.bin_a = y.bin_a AND x.bin_b = y.bin_b) AND abs(x.pos_a - y.pos_a) < 50000 AND abs(x.pos_b - y.pos_b) < 50000 GROUP BY 1, 2),
dn AS (SELECT lb.*, CASE WHEN lb.chr_a <> lb.chr_b AND split_part(lb.chr_a, '.', 1) = split_part(lb.chr_b, '.', 1) THEN own.c + coalesce(around, 0) < limit_ AND n > 1 ELSE true END AS keep
  FROM lb LEFT JOIN own USING (chr_a, chr_b, bin_a, bin_b) LEFT JOIN ar USING (pair_id, k) CROSS JOIN lm)"""
PAIRS = "pc AS (SELECT chr_a, chr_b, count(*) AS n_unambig FROM lb WHERE n = 1 GROUP BY 1, 2)"

R = views.plain(views.READS)
AD = "AGATCGGAAGAGC"
#: The clipping steps, one CTE each.
CLIP = f"""r AS ({R}),
a1 AS (SELECT *, instr(seq, '{AD[:7]}') AS i FROM r), a2 AS (SELECT *, substr(seq, cast(i AS int), 13) AS w FROM a1),
a3 AS (SELECT *, i > 0 AND (instr('{AD}', w) > 0 OR list_sum([CASE WHEN substr(w, j, 1) NOT IN ('N', substr('{AD}', j, 1)) THEN 1 ELSE 0 END FOR j IN range(1, length(w) + 1)]) < 2) AS hit FROM a2),
a4 AS (SELECT read_no, hit, CASE WHEN hit THEN substr(seq, 1, cast(i AS int) - 1) ELSE seq END AS seq, CASE WHEN hit THEN substr(qual, 1, cast(i AS int) - 1) ELSE qual END AS qual FROM a3),
j1 AS (SELECT *, instr(seq, 'GATCGATC') AS i FROM a4),
j2 AS (SELECT read_no, hit, i, CASE WHEN i > 0 THEN substr(seq, 1, cast(i AS int) - 1) || 'GATC' ELSE seq END AS seq, CASE WHEN i > 0 THEN substr(qual, 1, cast(i AS int) + 3) ELSE qual END AS qual FROM j1),
n1 AS (SELECT read_no, hit, i, regexp_replace(seq, 'N+$', '') AS seq, length(seq) - length(regexp_replace(seq, 'N+$', '')) AS k, qual FROM j2),
n2 AS (SELECT *, substr(qual, 1, length(qual) - k) AS q0 FROM n1),
q1 AS (SELECT *, regexp_replace(q0, '[\\x00-\\x2A]+$', '') AS q3 FROM n2), q2 AS (SELECT *, regexp_replace(q3, '^[\\x00-\\x2A]+', '') AS q5 FROM q1),
q4 AS (SELECT read_no, hit, i, k > 0 OR length(q5) < length(q0) AS low, q5 AS qual, substr(seq, length(q3) - length(q5) + 1, length(q5)) AS seq FROM q2),
c AS (SELECT read_no, hit, i, low, qual, CASE WHEN length(seq) = 0 THEN '' ELSE array_to_string([CASE WHEN ascii(substr(qual, j, 1)) < 43 THEN 'N' ELSE substr(seq, j, 1) END FOR j IN range(1, length(seq) + 1)], '') END AS seq FROM q4)"""

CO = views.CONTIGS["duckdb"]
PIECES = lambda pattern, n: f"""p0 AS (SELECT contig, length(seq) AS len, regexp_split_to_array(seq, '{pattern}') AS parts FROM co),
p1 AS (SELECT contig, len, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM p0),
p2 AS (SELECT contig, len, k, length(part) AS m, coalesce(sum(length(part) + {n}) OVER (PARTITION BY contig ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s, max(k) OVER (PARTITION BY contig) AS top FROM p1)"""  # noqa: E731

AL = views.plain(views.ALIGNMENTS)
NORMAL = f"""al AS ({AL}), x0 AS (SELECT *, (flag & 16) <> 0 AS rev FROM al WHERE (flag & 4) = 0),
x1 AS (SELECT *, rev AND regexp_matches(md, '[GCAT]0$') AS tail FROM x0), x2 AS (SELECT *, NOT tail AND regexp_matches(md, '^0[GCAT]') AS head FROM x1),
x3 AS (SELECT *, CASE WHEN tail THEN right(seq, 1) ELSE left(seq, 1) END AS base, least(ascii(CASE WHEN tail THEN right(qual, 1) ELSE left(qual, 1) END) - 33, 40) AS q FROM x2),
nm AS (SELECT read_no, "end" AS mate, contig AS chr, pos + CASE WHEN head AND base <> 'N' THEN 1 ELSE 0 END AS lo, pos + 50 - CASE WHEN tail AND base <> 'N' THEN 1 ELSE 0 END AS hi, rev,
  CASE WHEN (tail OR head) AND base <> 'N' THEN least(0, as_score + 2 + cast(floor(4 * q / 40.0) AS bigint)) ELSE as_score END AS score FROM x3),
no AS (SELECT read_no, mate, chr, CASE WHEN rev THEN hi ELSE lo END AS start, CASE WHEN rev THEN lo ELSE hi END AS stop, CASE WHEN rev THEN '-' ELSE '+' END AS strand, score FROM nm),
y0 AS (SELECT *, max(score) OVER (PARTITION BY read_no, mate) AS top, count(*) OVER (PARTITION BY read_no, mate) AS c FROM no),
y1 AS (SELECT *, row_number() OVER (PARTITION BY read_no, mate ORDER BY chr DESC, start DESC, stop DESC, strand DESC, score DESC) AS r, count(*) OVER (PARTITION BY read_no, mate) AS c2 FROM y0 WHERE c = 1 OR score > top - 9),
y2 AS (SELECT x.*, (SELECT count(*) FROM y1 z WHERE z.read_no = x.read_no AND z.mate = x.mate AND x.c2 = 2 AND z.r <> x.r AND z.chr = x.chr AND abs(z.start - x.start) < 1000 AND (z.score > x.score OR (z.score = x.score AND z.r < x.r))) AS worse FROM y1 x),
ok AS (SELECT * FROM y2 WHERE worse = 0),
pr AS (SELECT a.read_no, a.chr AS ca, a.start AS sa, a.stop AS ea, b.chr AS cb, b.start AS sb, b.stop AS eb, a.score + b.score AS total, max(a.score + b.score) OVER (PARTITION BY a.read_no) AS best
  FROM ok a JOIN ok b ON a.read_no = b.read_no AND a.mate = 1 AND b.mate = 2),
kept AS (SELECT *, count(*) OVER (PARTITION BY read_no) AS size FROM pr WHERE total >= best - 5)"""

BC, CD = views.plain(views.BARCODED), views.plain(views.CODES)
MATCH = f"""bc AS ({BC}), cd AS ({CD}), oc AS (SELECT DISTINCT code FROM bc),
mt AS (SELECT oc.code, cd.code AS "match", sample, hamming(oc.code, cd.code) AS distance FROM oc JOIN cd ON length(oc.code) = length(cd.code) AND hamming(oc.code, cd.code) <= 1),
um AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY code) AS c FROM mt) WHERE distance = 0 OR (c = 1)),
dm AS (SELECT read_no, bc.code, "match", sample, distance, "match" IS NOT NULL AS valid FROM bc LEFT JOIN um USING (code))"""

ORACLE: dict[str, str] = {
    "f_filter_counts": f"WITH {T} {COUNTS}",
    "f_filter_counts_re2": f"WITH {_tagged(re2=True)} {COUNTS}",
    "f_filter_counts_no_re": f"""WITH v AS ({V}), n AS (SELECT *, least(start_a, end_a) AS p1, greatest(start_a, end_a) AS p2, least(start_b, end_b) AS p3, greatest(start_b, end_b) AS p4, 20 + 140 AS size FROM v),
 s AS (SELECT *, CASE WHEN strand_a = '+' AND strand_b = '-' AND p1 < p3 THEN p4 - p1 WHEN strand_b = '+' AND strand_a = '-' AND p3 < p1 THEN p2 - p3 END AS span FROM n),
 t0 AS (SELECT *, CASE WHEN chr_a = 'chrU' OR chr_b = 'chrU' THEN 'unknown_contig' WHEN chr_a = chr_b AND span < 1 THEN 'no_insert' WHEN chr_a = chr_b AND span < 75 THEN 'too_close' ELSE 'accepted' END AS tag0 FROM s),
 t AS (SELECT CASE WHEN tag0 = 'accepted' AND max(tag0 <> 'accepted') OVER (PARTITION BY pair_id) THEN 'excluded_group' ELSE tag0 END AS tag FROM t0) {COUNTS}""",
    "f_filtered_rows": f"WITH {T} SELECT pair_id, line_no, chr_a, start_a, chr_b, start_b, f_start_a, f_end_a, f_start_b, f_end_b, CASE WHEN idx_a IS NULL OR idx_b IS NULL THEN NULL ELSE size END AS size, tag, separation FROM t",
    "f_separations": f"WITH {T} SELECT separation, count(*) AS n FROM t WHERE separation IS NOT NULL GROUP BY 1",
    "f_size_histogram": f"WITH {T}, {HISTOGRAM} SELECT * FROM h",
    "f_junction_histogram": f"WITH {T} SELECT strand, cast(floor(d / 10) AS bigint) AS bin, count(*) AS n FROM (SELECT strand_a AS strand, da AS d FROM t WHERE tag <> 'unknown_contig' UNION ALL SELECT strand_b, db FROM t WHERE tag <> 'unknown_contig') WHERE floor(d / 10) < 100 GROUP BY 1, 2",
    "c4_asof_fragment": f"WITH v AS ({V}), fr AS ({FR}) SELECT pair_id, line_no, chr_a, end_a, idx_a AS idx, f_start_a AS f_start, f_end_a AS f_end FROM {_asof('v', 'fr', 'a', '')} q",
    "c5_asof_star": f"""WITH v AS ({V}), st AS (SELECT DISTINCT chr, frag_start AS pos FROM ({FR2})), mm AS (SELECT chr, min(pos) AS lo, max(pos) AS hi FROM st GROUP BY chr),
 x AS (SELECT v.*, up.pos AS up, mm.lo, mm.hi FROM v ASOF LEFT JOIN st up ON v.chr_a = up.chr AND v.start_a <= up.pos LEFT JOIN mm ON v.chr_a = mm.chr),
 y AS (SELECT x.*, dn.pos AS dn FROM x ASOF LEFT JOIN st dn ON x.chr_a = dn.chr AND x.start_a > dn.pos)
 SELECT pair_id, line_no, chr_a, start_a, strand_a, CASE WHEN strand_a = '+' THEN coalesce(up, hi) ELSE coalesce(dn, lo) END AS star FROM y""",
    "g1_dedupe": f"WITH {T}, {RUNS} SELECT acc.pair_id, line_no, start_a, start_b, cast(repeats AS bigint) AS repeats FROM acc JOIN reps USING (pair_id) WHERE pair_id NOT IN (SELECT pair_id FROM lost) AND repeats / places >= 2",
    "g2_dedupe_stats": f"""WITH {T}, {RUNS}, z AS (SELECT *, pair_id IN (SELECT pair_id FROM lost) AS gone FROM reps)
 SELECT count(*) AS input_reads, count(*) FILTER (gone) AS redundant, count(*) FILTER (NOT gone) AS effective, count(*) FILTER (NOT gone AND repeats / places < 2) AS unique_reads,
 count(*) FILTER (NOT gone AND repeats / places >= 2) AS supported, round(sum(repeats) FILTER (NOT gone) / count(*) FILTER (NOT gone), 6) AS mean_redundancy FROM z""",
    "g1_dedupe_hybrid_population": f"WITH {T}, {RUNS_2} SELECT acc.pair_id, line_no, start_a, start_b, cast(repeats AS bigint) AS repeats, repeats / places >= 2 AS supported FROM acc JOIN reps USING (pair_id) WHERE pair_id NOT IN (SELECT pair_id FROM lost)",
    "g3_promiscuous_ends": f"WITH {T}, {ENDS} SELECT c AS chr, p AS pos, s AS strand, n_ends, n_groups, remove, resolve FROM ends",
    "g4_promiscuity_stats": f"""WITH {T}, {ENDS}, hit AS (SELECT pair_id, bool_or(remove) AS rm, bool_or(resolve) AS rs FROM e JOIN ends USING (c, p, s) GROUP BY 1)
 SELECT CASE WHEN rm THEN 'promiscuous' WHEN rs THEN 'resolved' ELSE 'clean' END AS promiscuity, count(*) AS n FROM (SELECT DISTINCT pair_id FROM acc) LEFT JOIN hit USING (pair_id) GROUP BY 1""",
    "g5_contact_stats": f"""WITH {T}, {POS}, gr AS (SELECT pair_id, count(*) AS c, max(CASE WHEN chr_a <> chr_b THEN 2 WHEN abs(pos_a - pos_b) < 10000 THEN 0 ELSE 1 END) AS code FROM pos GROUP BY 1)
 SELECT count(*) AS total_contacts, count(*) FILTER (c > 1) AS ambig_contacts, cast(sum(c) AS bigint) AS total_pairs, round(coalesce(sum(c) FILTER (c > 1), 0) / greatest(count(*) FILTER (c > 1), 1), 6) AS mean_ambiguity,
 count(*) FILTER (code = 0) AS cis_near, count(*) FILTER (code = 1) AS cis_far, count(*) FILTER (code = 2) AS trans, count(*) FILTER (code = 3) AS homolog_trans FROM gr""",
    "g13_quartile_edges": f"WITH {T}, {HISTOGRAM}, c AS (SELECT *, sum(n) OVER (PARTITION BY series ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY series) AS al FROM h) SELECT series, share, min(bin) + 1 AS edge FROM c, (VALUES (0.25::double), (0.75::double)) s(share) WHERE cum >= share * al GROUP BY 1, 2",
    "g14_sample_table": f"""WITH {T} SELECT 's' || (pair_id % 4) AS sample, round(100.0 * count(*) FILTER (tag = 'accepted') / count(*), 6) AS pc_accepted,
 round(100.0 * count(*) FILTER (tag IN ('adjacent_re1', 'overhang_re1', 'too_close', 'no_insert', 'too_small', 'too_big', 'no_end_re2', 'internal_re2')) / count(*), 6) AS pc_other FROM t GROUP BY 1""",
    "b_clipped_reads": f"WITH {CLIP} SELECT read_no, seq, qual FROM c WHERE length(seq) >= 18",
    "b10_clip_stats": f"""WITH {CLIP} SELECT count(*) AS input_reads, count(*) FILTER (i > 0) AS junction, count(*) FILTER (low) AS quality, count(*) FILTER (hit) AS adapter, count(*) FILTER (length(seq) < 18) AS short,
 round(sum(CASE WHEN length(seq) >= 18 THEN length(seq) ELSE 0 END) / count(*), 6) AS mean_length FROM c""",
    "b11_junction_positions": f"""WITH {CLIP}, h AS (SELECT i - 1 AS pos, count(*) AS n FROM c WHERE i > 0 GROUP BY 1), sp AS (SELECT unnest(range((SELECT max(pos) FROM h) + 1)) AS pos)
 SELECT cast(sp.pos AS bigint) AS pos, coalesce(n, 0) AS n, round(100.0 * coalesce(n, 0) / (SELECT count(*) FROM c), 6) AS percent FROM sp LEFT JOIN h ON sp.pos = h.pos""",
    "b12_quality_scheme": f"WITH r AS ({R}), q AS (SELECT min(ascii(x)) AS lo, max(ascii(x)) AS hi FROM (SELECT unnest(string_split(qual, '')) AS x FROM r) WHERE x <> '') SELECT lo, hi, CASE WHEN lo < 33 THEN 'integer' WHEN hi < 75 AND lo < 59 THEN 'phred33' WHEN hi > 74 AND lo < 64 THEN 'solexa' WHEN hi > 74 THEN 'phred64' ELSE 'phred33' END AS scheme FROM q",
    "d1_fragments": f"WITH co AS ({CO}), {PIECES('GATC', 4)}, f AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY k) - 1 AS idx, max(k) OVER (PARTITION BY contig) AS lastk FROM p2 WHERE m > 0) SELECT contig, idx AS frag_idx, cast(s AS bigint) AS frag_start, cast(CASE WHEN k = lastk THEN len - 1 ELSE s + m + 3 END AS bigint) AS frag_end FROM f",
    "d2_star_sites": " UNION ALL ".join(f"SELECT contig, cast(s AS bigint) AS pos FROM (WITH co AS ({CO}), {PIECES(p, 4)} SELECT * FROM p2 WHERE k < top) u" for p in ("GATC", "AAT[AGCT]")),
    "d4_windows": f"""WITH co AS ({CO}), w0 AS (SELECT contig, seq, unnest(range(0, length(seq), 150)) AS start FROM co), w1 AS (SELECT contig, start, substr(seq, start + 1, 200) AS w FROM w0),
 w2 AS (SELECT *, ltrim(w, 'N') AS l, trim(w, 'N') AS x FROM w1) SELECT contig, cast(start AS bigint) AS start, cast(start + length(w) AS bigint) AS "end", length(w) - length(l) AS lead, length(l) - length(x) AS tail, md5(x) AS window_md5 FROM w2 WHERE length(x) > 18""",
    "e1_normalised": f"WITH {NORMAL} SELECT * FROM no",
    "e9_pair_stats": f"""WITH {NORMAL}, rd AS (SELECT DISTINCT read_no FROM no), kp AS (SELECT read_no, max(size) AS size, max(best) AS best FROM kept GROUP BY 1)
 SELECT CASE WHEN best IS NULL THEN 'unmapped_end' WHEN best < -24 THEN 'all_poor' WHEN size = 1 THEN 'unique' ELSE 'ambiguous' END AS outcome, count(*) AS n FROM rd LEFT JOIN kp USING (read_no) GROUP BY 1""",
    "e8_contacts": f"""WITH {NORMAL} SELECT read_no AS pair_id, count(*) AS rows_out, max(size) AS ambig_size, cast(sum(CASE WHEN ca > cb OR (ca = cb AND sa > sb) THEN 1 ELSE 0 END) AS bigint) AS swapped,
 cast(sum(sa + sb + ea + eb) AS bigint) AS places, max(size) AS marker FROM kept WHERE best >= -24 GROUP BY 1""",
    "c3_unpaired": f"WITH {NORMAL}, m AS (SELECT DISTINCT read_no, mate FROM no) SELECT mate, count(*) AS n FROM m WHERE NOT EXISTS (SELECT 1 FROM m z WHERE z.read_no = m.read_no AND z.mate <> m.mate) GROUP BY 1",
    "a17_mapping_stats": f'WITH al AS ({AL}), c AS (SELECT read_no, "end", count(*) FILTER ((flag & 4) = 0) AS n FROM al GROUP BY 1, 2) SELECT count(*) AS n_reads, count(*) FILTER (n = 1) AS uniq, count(*) FILTER (n > 1) AS ambiguous, count(*) FILTER (n = 0) AS unmapped FROM c',
    "c16_demultiplex": f"WITH {MATCH} SELECT * FROM dm",
    "g6_code_counts": f"WITH bc AS ({BC}) SELECT code, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM bc GROUP BY 1",
    "g6_levels": f"WITH bc AS ({BC}), c AS (SELECT code, count(*) AS n FROM bc GROUP BY 1) SELECT cast(level AS bigint) AS level, count(*) FILTER (n >= level) AS n FROM c, (SELECT unnest([1000000, 100000, 10000, 1000, 100]) AS level) GROUP BY 1",
    "g7_demux_stats": f"WITH {MATCH} SELECT count(*) AS n_reads, count(*) FILTER (valid) AS n_valid, count(*) FILTER (distance = 0) AS n_perfect, count(*) FILTER (distance > 0) AS n_imperfect, count(*) FILTER (NOT valid) AS n_lost FROM dm",
    "a24_sample_names": f"""WITH bc AS ({BC}), cd AS ({CD}), c AS (SELECT code, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM bc GROUP BY 1)
 SELECT code, n, percent, coalesce(sample, 'sample_' || row_number() OVER (PARTITION BY sample IS NULL ORDER BY n DESC, code DESC)) AS sample FROM c LEFT JOIN cd USING (code)""",
    "g8_simple_demux": f"WITH r AS ({R}), p AS (SELECT substr(seq, 1, 3) AS a, substr(CASE WHEN read_no % 3 = 0 THEN reverse(seq) ELSE seq END, 1, 3) AS b FROM r) SELECT count(*) AS n_pairs, count(*) FILTER (a = b) AS matched, count(*) FILTER (a <> b) AS mismatched, count(*) FILTER (contains(a, 'N')) AS with_n FROM p",
    "g9_pair_counts": f"WITH {T}, {LOADED}, {PAIRS} SELECT * FROM pc",
    "i1_loaded": f"WITH {T}, {LOADED} SELECT * FROM lb",
    "i2_network_scores": f"WITH {T}, {LOADED}, {SCORES} SELECT chr_a, chr_b, pos_a, pos_b, round(score, 6) AS score FROM sc",
    "i3_dense_homologs": f"WITH {T}, {LOADED}, {DENSE} SELECT pair_id, count(*) AS rows_in, count(*) FILTER (keep) AS kept FROM dn GROUP BY 1",
    "i4_without_isolated": f"""WITH {T}, {LOADED}, {DENSE}, km AS (SELECT *, sum(keep::int) OVER (PARTITION BY pair_id) AS m FROM dn), sg AS (SELECT * FROM km WHERE m = 1 AND keep), o AS (SELECT * FROM km WHERE n = 1 AND keep),
 d AS (SELECT sg.pair_id, o.pos_a - sg.pos_a AS d1, o.pos_b - sg.pos_b AS d2, sg.bin_a = o.bin_a AND sg.bin_b = o.bin_b AS own FROM sg JOIN o ON sg.chr_a = o.chr_a AND sg.chr_b = o.chr_b AND abs(sg.bin_a - o.bin_a) <= 1 AND abs(sg.bin_b - o.bin_b) <= 1),
 sc AS (SELECT pair_id, bool_or(own) AS own, log10((1 + sum(CASE WHEN fits AND d1 < 0 THEN {KERNEL("d1")} ELSE 0 END + CASE WHEN fits AND d2 < 0 THEN {KERNEL("d2")} ELSE 0 END)) * (1 + sum(CASE WHEN fits AND d1 >= 0 THEN {KERNEL("d1")} ELSE 0 END + CASE WHEN fits AND d2 >= 0 THEN {KERNEL("d2")} ELSE 0 END))) AS score
  FROM (SELECT *, CASE WHEN own THEN d1 <> 0 AND d2 <> 0 ELSE abs(d1) < 50000 AND abs(d2) < 50000 END AS fits FROM d) GROUP BY 1),
 iso AS (SELECT sg.pair_id FROM sg LEFT JOIN sc USING (pair_id) WHERE NOT coalesce(own, false) OR coalesce(score, 0) < 0.01)
 SELECT pair_id, count(*) FILTER (CASE WHEN m = 0 OR pair_id IN (SELECT pair_id FROM iso) THEN false WHEN m < n AND m > 1 THEN keep ELSE true END) AS kept FROM km GROUP BY 1""",
    "i5_missing_cis": f"""WITH {T}, {LOADED.replace('lb AS (', 'l0 AS MATERIALIZED (')}, mv AS (SELECT *, chr_a = 'chr2' AND chr_b = 'chr2' AND pair_id % 5000 <> 1 AS moved FROM l0),
 lb AS (SELECT n, CASE WHEN moved THEN 'chr1.a' ELSE chr_a END AS chr_a, CASE WHEN moved THEN 'chr1.a' ELSE chr_b END AS chr_b FROM mv), {PAIRS}
 SELECT chr FROM (SELECT chr_a AS chr FROM lb UNION SELECT chr_b FROM lb) c LEFT JOIN (SELECT chr_a AS chr, n_unambig FROM pc WHERE chr_a = chr_b) USING (chr) WHERE coalesce(n_unambig, 0) < 5""",
    "i7_trans_relay": f"""WITH {T}, {LOADED}, {PAIRS}, b2 AS (SELECT chr_a, chr_b, n_unambig FROM pc WHERE chr_a <> chr_b UNION ALL SELECT chr_b, chr_a, n_unambig FROM pc WHERE chr_a <> chr_b)
 SELECT chr_a, chr_b, round(sum(v), 6) AS relay FROM (SELECT x.chr_a, y.chr_a AS chr_b, sqrt(x.n_unambig * y.n_unambig) AS v FROM b2 x JOIN b2 y ON x.chr_b = y.chr_b AND x.chr_a < y.chr_a
 UNION ALL SELECT chr_a, chr_b, 5.0::double * n_unambig FROM pc WHERE chr_a <> chr_b) GROUP BY 1, 2""",
    "j1_contact_map": f"WITH {T}, {POS} SELECT chr_a, chr_b, cast(floor(pos_a / 100000) AS bigint) AS bin_a, cast(floor(pos_b / 100000) AS bigint) AS bin_b, count(*) AS n FROM pos GROUP BY 1, 2, 3, 4",
    "j2_contact_probability": f"""WITH {T}, {POS}, sep AS (SELECT cast(floor(abs(pos_a - pos_b) / 100000) AS bigint) AS bin, count(*) AS n FROM pos WHERE chr_a = chr_b GROUP BY 1),
 s AS (SELECT cast(floor((hi - lo) / 100000) AS bigint) + 1 AS bins FROM lim), p AS (SELECT bin, sum(bins - bin) AS possible FROM (SELECT bins, unnest(range(bins)) AS bin FROM s) GROUP BY 1)
 SELECT sep.bin, n, round(n / possible, 9) AS probability FROM sep JOIN p ON sep.bin = p.bin""",
    "j3_trans_density": f"WITH {T}, {POS} SELECT chr_a, chr_b, count(*) AS n, round(count(*) / (max((a.hi - a.lo + 1) / 1e6) * max((b.hi - b.lo + 1) / 1e6)), 9) AS density FROM pos JOIN lim a ON chr_a = a.chr JOIN lim b ON chr_b = b.chr WHERE chr_a <> chr_b GROUP BY 1, 2",
    "j3_isolated": f"""WITH {T}, {POS}, b AS (SELECT chr_a, chr_b, floor(pos_a / 20000) AS x, floor(pos_b / 20000) AS y, count(*) AS n FROM pos GROUP BY 1, 2, 3, 4),
 r AS (SELECT b.chr_a, b.chr_b, b.x, b.y, max(b.n) AS n, sum(o.n) AS around FROM b JOIN b o ON b.chr_a = o.chr_a AND b.chr_b = o.chr_b AND abs(b.x - o.x) <= 1 AND abs(b.y - o.y) <= 1 GROUP BY 1, 2, 3, 4)
 SELECT CASE WHEN chr_a = chr_b THEN 'cis' ELSE 'trans' END AS kind, cast(sum(n) AS bigint) AS n, count(*) FILTER (around = 1) AS isolated FROM r GROUP BY 1""",
    "j4_chromosome_limits": f"WITH {T}, {POS} SELECT chr, lo, hi FROM lim",
}
