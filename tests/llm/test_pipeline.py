import random
import re
import zlib

import corpus_pipeline
from contactloom.llm import packing


def test_stages(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "tau"]) + str(rng.randrange(50)) for _ in range(n))
    good = [text(120) for _ in range(6)]
    near = good[0].replace(good[0].split()[5], "changed", 1)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*good, good[0], near, "too short", good[1] + " token=abcdefgh12345678"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.write_table(spark, stage(spark, docs, str(tmp_path)), name)
        seen[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == df.columns
    ids = lambda n: {r.doc_id for r in seen[n].collect()}
    assert 8 not in ids("quality_rules") and set(range(6)) <= ids("quality_rules")
    assert ids("ngram_jaccard_join") == {0, 1, 2, 3, 4, 5}
    assert all("abcdefgh12345678" not in r.text for r in seen["secret_scans"].collect())
    assert ids("best_fit_packing") == ids("secret_scans")


def plain_pipeline(rows, kept):
    """(doc_id, piece, start, length, ids_crc32) of near duplicates, repeated passages, secrets and pieces done plainly."""
    docs = sorted((i, t) for i, t in rows if i in kept)
    grams = {}
    for i, t in docs:
        w = t.split()
        grams[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    classes = {i: i for i, _ in docs}
    for i, _ in docs:
        for j, _ in docs:
            if j < i and 5 * len(grams[i] & grams[j]) >= 4 * len(grams[i] | grams[j]):
                a, b = classes[i], classes[j]
                classes = {k: min(a, b) if v in (a, b) else v for k, v in classes.items()}
    docs = [(i, t) for i, t in docs if classes[i] == i]
    first: dict[bytes, int] = {}
    pieces = []
    tokenizer = packing.tokenizer_at(packing.tokenizer_path(packing.TOKENIZER))
    for i, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.setdefault(b[k : k + 50], i) < i:
                gone[k : k + 50] = b"x" * 50
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g).decode()
        if left != t and not left.strip():
            continue
        ids = [*tokenizer.encode(SECRET.sub("[SECRET]", left), add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            pieces.append((i, k // 4096, k, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    return sorted(pieces)


SECRET = re.compile(r"password: [A-Za-z0-9]{12,}")


def test_the_whole_run_against_a_plain_version(spark, tmp_path):
    rng = random.Random(12)
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect() if r.text and "password" not in r.text]
    texts = {r.doc_id: r.text for r in docs if not re.search(r"[0-9]|AKIA|secret|token|key", r.text)}
    ids = sorted(texts)[:30]
    passage = " ".join(texts[ids[0]].split()[:25])
    rows = [(i, texts[i], r.lang) for i in ids for r in docs if r.doc_id == i]
    words = texts[ids[1]].split()
    rows += [(9000, texts[ids[1]], rows[1][2]), (9001, " ".join(words[:-1]), rows[1][2]), (9002, texts[ids[2]] + " password: Zk3vQp81LmXw9 " + passage, rows[2][2]), (9003, "too short", "en"), (9004, None, "en"), (9005, "", "en")]
    rng.shuffle(rows)
    table = spark.createDataFrame([(i, t, lang, f"s{i % 3}", len(t or ""), 0.5) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, rank double")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.keep_good.__wrapped__(spark, table, "").collect()}
    assert not kept & {9003, 9004, 9005} and len(kept) > 15
    one = corpus_pipeline.run(spark, str(tmp_path))
    two = corpus_pipeline.run(spark, str(tmp_path))
    want = plain_pipeline([(i, t) for i, t, _ in rows], kept)
    for got in (two, one):  # the second run leaves the first one's result alone
        found = got.collect()
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
        places = sorted((r.sequence_id, r.offset, r.length) for r in found)
        assert all((o == 0) if k == 0 or places[k - 1][0] != s else o == sum(places[k - 1][1:]) for k, (s, o, _) in enumerate(places))


def test_stages_take_empty_tables_and_other_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, h1 string, batch int, kept boolean"
    docs = spark.createDataFrame([], schema)
    for _, call in corpus_pipeline.STAGES[:-1]:
        got = call.__wrapped__(spark, docs, "")
        assert got.columns == docs.columns and got.count() == 0
    assert corpus_pipeline.pack.__wrapped__(spark, docs, "").count() == 0
    text = "one clean sentence of plain words that says little but says it well and at some length for a test"
    docs = spark.createDataFrame([(None, text, None, None, None, 7, "x", 3, True), (1, text, "en", "s", 5, 8, "y", 4, False), (2, None, None, None, None, None, None, None, None)], schema)
    for _, call in corpus_pipeline.STAGES[1:-1]:
        got = call.__wrapped__(spark, docs, "")
        assert got.columns == docs.columns and {r.row for r in got.collect()} <= {7, 8, None}
