"""Periodic runs against a brute-force version."""

import hashlib
import random
import re
import zlib

import pytest

from contactloom.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    n, runs = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                runs.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in runs.items())


def test_runs_of_made_words():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.choice([5, 12, 13, 40, 150, 400, 700])
        w = [rng.randrange(rng.choice([1, 2, 3, 10, 100])) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            a, p, b = rng.randrange(n), rng.randrange(1, max(2, n // 2)), rng.randint(1, n)
            for i in range(a + p, min(n, a + b)):
                w[i] = w[i - p]
        assert periodic_runs.find(periodic_runs.word_ids(w)) == brute(w)


@pytest.mark.parametrize("words, first", [([0] * 200_000, (0, 200_000, 1)), ([i % 7001 for i in range(90_000)], (0, 90_000, 7001)), ([i % 97 if i % 9000 else -1 for i in range(90_000)], (1, 8999, 97))])
def test_long_texts(words, first):
    assert first in periodic_runs.find(periodic_runs.word_ids(words))


def test_fibonacci_words_have_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert periodic_runs.find(periodic_runs.word_ids(b[:1500])) == brute(b[:1500])


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(160):
        words = [rng.choice(["a", "bé", "字", "d.", " x", "e f"]) for _ in range(rng.randint(0, 260))]
        if i % 3 == 0 and words:
            words += words[: rng.randint(1, len(words))] * rng.randint(1, 4)
        rows.append((i, "".join(w + rng.choice([" ", "\n", " \t", "\x0b", "\r\n"]) for w in words), i))
    rows += [(500, None, 1), (501, "", 1), (502, " \n ", 1), (503, "x " * 5000, 1), (504, "a b c d e f " * 2, 1), (504, "a b c d e f " * 2, 1), (None, "y y " * 20, 1), (505, "a b " * 5 + "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert all(t == "bigint" for c, t in got.dtypes if not c.endswith("sha256"))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((plain_row(i, t) for i, t, _ in rows), key=key)


def test_find_runs_keeps_its_own_outputs(spark):
    df = spark.createDataFrame([("k", "z " + "a b c " * 5 + "end"), (None, None)], "doc_id string, text string")
    got = {r.doc_id: r for r in periodic_runs.find_runs(df).collect()}
    assert [tuple(r) for r in got["k"].runs] == [(1, 15, 3)] and got["k"].collapsed == "z a b c end" and got["k"].n_words == 17
    assert got[None].runs == [] and got[None].collapsed == ""
    assert periodic_runs.find_runs(df.limit(0)).count() == 0
