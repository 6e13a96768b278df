"""Cross-tokenizer alignment against a plain version that encodes whole texts and compares byte ranges."""

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from contactloom.llm import token_align

A, B = (token_align.tokenizer_path(n) for n in (token_align.A_FILE, token_align.B_FILE))
TEXTS = [
    "The cat sat, didn't it? 12345 6.5", "a  b", " lead", "trail ", "tab\tnew\n line\r\n x \n y", "  ", "", None, "été ñandú größe", "字字 😀 \x00 x", "low ▁ bar", "<|endoftext|> is plain <s> </s> <unk> <0x41>",
    "nbsp x   y　 z", "x \x1c y", "  x", "é ﻿ q", "ﬁ ① Ａ", "a" * 3000, "word " * 400 + "end", "'s 're '", "x\x85 y \x85", "The cat sat, didn't it? 12345 6.5",
]


def ends(sizes):
    out, at = [], 0
    for n in sizes:
        out.append((at, at + n))
        at += n
    return out


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    # the same vocabulary in another form tells the bytes of A's entries
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        a_bytes = {int(n): base64.b64decode(t) for t, n in map(bytes.split, f)}

    def b_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        x, y, want = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
        if b"".join(a_bytes[i] for i in x) != want or b"".join(map(b_bytes, y)) != want:
            return None
        ra, rb = ends([len(a_bytes[i]) for i in x]), ends([len(b_bytes(i)) for i in y])
        links = [(x[i], y[j]) for i, p in enumerate(ra) for j, q in enumerate(rb) if p[0] < q[1] and q[0] < p[1]] if len(ra) * len(rb) < 10**6 else None
        if links is None:  # long: walk both
            links, i, j = [], 0, 0
            while i < len(ra) and j < len(rb):
                links.append((x[i], y[j]))
                e, f = ra[i][1], rb[j][1]
                i, j = i + (e <= f), j + (f <= e)
        groups, ga, gb, cuts = [], [], [], {q for _, q in ra} & {q for _, q in rb}
        ia = ib = 0
        for c in sorted(cuts):
            ga, gb = [], []
            while ia < len(ra) and ra[ia][1] <= c:
                ga.append(x[ia])
                ia += 1
            while ib < len(rb) and rb[ib][1] <= c:
                gb.append(y[ib])
                ib += 1
            groups.append((ga, gb))
        return x, y, groups, links

    return one


def expected(plain, rows):
    got = [(i, plain(t)) for i, t in rows]
    count = Counter(p for _, r in got if r for p in r[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for i, r in got:
        if r is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in r[2])
            out.append((i, len(r[0]), len(r[1]), len(r[2]), len(r[3]), sum(count[p] == most[p[1]] for p in r[3]), sum(count[p] for p in r[3]), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_query(spark, plain, tmp_path):
    rng = random.Random(3)
    letters = ["the", "re", "ing", "É", "ß", " ", "  ", "\n", "\t", ".", "1", "字", "'ll", "-", "X", " ", "😀", "▁"]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(700, "same row"), (700, "same row"), (None, "no id")]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, pair int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = token_align.query(spark, str(tmp_path))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(plain, rows), key=key)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]


def test_slices_do_not_matter(spark, plain, tmp_path, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(map(tuple, token_align.score(spark, df, A, B).collect())) == sorted(expected(plain, rows))
    assert token_align.score(spark, df.limit(0), A, B).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in token_align.score(spark, nothing, A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_groups_and_counts(spark, plain):
    rows = [(f"k{i}", t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r for r in token_align.align(df, A, B).collect()}
    for i, t in rows:
        r, want = got[i], plain(t)
        if want is None:
            assert (r.a_ids, r.b_ids, r.bytes) == ([], [], [])
            continue
        assert (r.a_ids, r.b_ids) == (list(want[0]), list(want[1])) and r.bytes[-1] == len((" " + t).encode())
        cut = lambda ids, stops: [ids[x:y] for x, y in zip([0, *stops], stops, strict=False)]
        assert list(zip(cut(r.a_ids, r.a_ends), cut(r.b_ids, r.b_ends), strict=True)) == want[2]
    counts = Counter(p for _, t in rows if (r := plain(t)) for p in r[3])
    links = token_align.link_counts(spark, df.selectExpr("cast(null as long) doc_id", "text"), A, B)
    assert {(r.a_id, r.b_id): r.links for r in links.collect()} == counts
