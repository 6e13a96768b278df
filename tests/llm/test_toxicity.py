"""Toxicity: the kernel against its definition, the trie against the kernel, and held-out accuracy on made-up texts."""

import itertools
import random
import zlib

import numpy as np
import pytest

from contactloom.llm import toxicity
from contactloom.llm.toxicity import BEGIN, END

B, E = chr(BEGIN), chr(END)
INSULTS = ["idiot", "stupid", "wretch", "vermin"]


def phi(unit):
    out = {}
    for places in itertools.combinations(range(len(unit)), toxicity.ORDER):
        span = places[-1] - places[0] + 1
        if span <= toxicity.SPAN:
            v = "".join(unit[i] for i in places)
            out[v] = out.get(v, 0.0) + toxicity.DECAY ** (span - toxicity.ORDER)
    return out


def norm(n):
    return (1 + sum(x * x for x in phi("".join(chr(100 + i) for i in range(n))).values())) ** 0.5  # all different


def test_kernel_is_its_definition():
    rng = random.Random(1)
    words = [B + "".join(rng.choice("abcdé") for _ in range(rng.randint(0, 14))) + E for _ in range(40)]
    got = toxicity.kernel([toxicity.subsequences(w) for w in words], [toxicity.subsequences(w) for w in words])
    for (i, a), (j, b) in itertools.product(enumerate(words), repeat=2):
        x, y = phi(a), phi(b)
        assert got[i, j] == pytest.approx(sum(x[v] * y.get(v, 0.0) for v in x) / norm(len(a)) / norm(len(b)))
    assert np.linalg.eigvalsh(got).min() > -1e-9


def test_trie_gives_the_sum_over_landmarks():
    rng = random.Random(2)
    marks = [B + "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 9))) + E for _ in range(12)]
    alpha = np.array([rng.uniform(-1, 1) for _ in marks])
    model = toxicity._collapsed(marks, alpha, 0.25)
    texts = [" ".join("".join(rng.choice("abcdéx字.") for _ in range(rng.randint(1, 70))) for _ in range(30)), "", "...", "a b c d"]
    u = toxicity.units(texts)
    want = toxicity.kernel([toxicity.subsequences(s) for s in u.strings(np.arange(len(u.size)))], [toxicity.subsequences(z) for z in marks]) @ alpha + 0.25
    assert model(u) == pytest.approx(want, abs=1e-5)


def test_units():
    def of(text):
        u = toxicity.units(["zz", text, None or ""])
        return [s for s, t in zip(u.strings(np.arange(len(u.size))), u.text.tolist(), strict=True) if t == 1]

    mark = lambda *w: [B + x + E for x in w]
    assert sorted(of("The  «Cat», sat")) == sorted(mark("the", "cat", "sat"))
    assert sorted(of("an i d i o t!")) == sorted(mark("an", "idiot"))
    assert sorted(of("I-d.i*ot x")) == sorted(mark("i-d.i*ot", "idiot", "x"))
    assert of(" ?! \n ") == [] and of("") == []
    long = of("q" * 30 + "idiot" + "r" * 100)
    assert any("idiot" in s for s in long) and all(len(s) <= toxicity.WINDOW for s in long) and long[0][0] == B and long[-1][-1] == E


def test_greatest_counts_equal_units_once():
    u = toxicity.units(["aa bb aa aa", "", "cc"])
    value = {"aa": 2.0, "bb": 1.0, "cc": -5.0}
    values = np.array([value[s[1:-1]] for s in u.strings(np.arange(len(u.size)))])
    best = toxicity.greatest(u, values, -1.0, 3, 3)
    assert best.tolist() == [[2.0, 1.0, -1.0], [-1.0] * 3, [-1.0] * 3]


def test_sketches_tell_near_copies():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(400)]
    near = [" ".join(words[:i] + ["edited"] + words[i + 1 :]) for i in range(40, 400, 40)]
    got = toxicity.sketches([" ".join(words), *near, "", " . ", "one two", "one, TWO!", " ".join(reversed(words))]).tolist()
    assert sum(x == got[0] for x in got[1:10]) >= 7
    assert got[10] == got[11] and got[12] == got[13] and len({got[0], got[10], got[12], got[14]}) == 4
    assert toxicity.sketches([]).tolist() == []


def made(n, rng):
    syllables = ["tha", "re", "ing", "o", "ble", "sti", "id", "val", "mon", "st", "ot", "an", "é"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(INSULTS)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def write(spark, rows, path, labels=None):
    spark.createDataFrame([(i, t, "en", 0.5) for i, t, _ in rows], "doc_id long, text string, lang string, score double").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows] if labels is None else labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_held_out_texts(spark, tmp_path):
    rows = made(1200, random.Random(3))
    evasive = [f"thare {w} oble an" for w in ("i-d-i-o-t", "i d i o t", "idxiot", "stu*pid", "wre.tch", "ver_min", "STUPID")]
    extra = [(5000 + i, t, None) for i, t in enumerate(evasive)] + [(6000, None, None), (6001, "", None), (6002, "tha re", None), (None, "stupid", None)]
    write(spark, rows + extra, tmp_path, [(i, 1, y) for i, _, y in rows] + [(0, 1, 1), (None, 1, 0), (1, 1, None)])
    got = toxicity.query(spark, str(tmp_path))
    assert [(c, t) for c, t in got.dtypes] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    out = {r.doc_id: r for r in got.collect()}
    assert len(out) == len(rows) + len(extra)
    for r in out.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [(out[i].predicted, y) for i, _, y in rows if out[i].held_out]
    assert len(held) > 100 and sum(p == y for p, y in held) / len(held) > 0.97
    assert [i for i in range(5000, 5007) if not out[i].predicted] == []
    assert not any(out[i].predicted for i in (6000, 6001, 6002)) and out[None].predicted and out[6000].score == out[6001].score


def test_labels_of_held_out_rows_are_not_used(spark, tmp_path):
    rows = made(300, random.Random(4))
    flipped = [(i, 1, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, _, y in rows]
    write(spark, rows, tmp_path / "a")
    write(spark, rows, tmp_path / "b", flipped)
    a, b = ({r.doc_id: r.score for r in toxicity.query(spark, str(tmp_path / x)).collect()} for x in "ab")
    assert a == pytest.approx(b)


def test_without_examples(spark, tmp_path):
    rows = [(i, f"words {i}", 0) for i in range(20)]
    write(spark, rows, tmp_path / "clean")
    assert {r.predicted for r in toxicity.query(spark, str(tmp_path / "clean")).collect()} == {0}
    write(spark, rows, tmp_path / "none", [])
    assert toxicity.query(spark, str(tmp_path / "none")).count() == 20
    write(spark, [], tmp_path / "empty", [])
    assert toxicity.query(spark, str(tmp_path / "empty")).count() == 0
