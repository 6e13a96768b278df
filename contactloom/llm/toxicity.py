"""Toxicity: a support vector machine over a subsequence string kernel with Nyström landmarks.

Units. A text's lower-cased words without outer punctuation, a mark before and after each; letters that stand alone are
joined when they follow each other ("i d i o t"), and a word with inner punctuation also counts without it ("i-d.iot").
Long units are cut to overlapping windows. A text is a bag of units.

Kernel. k(u, z) sums over all subsequences v of four characters phi_v(u) * phi_v(z) / sqrt(N(|u|) N(|z|)), where phi_v(u) is
the sum of DECAY ** gaps over the places of v in u that span at most seven characters, and N(n) is the value of k(u, u)
before scaling if all subsequences of a unit of n characters differ. Scaling by a function of each argument keeps it a
kernel. Inserted characters cost a gap each, so "idxiot" stays near "idiot".

Landmarks. Units that go with toxic texts, common ones, and clean ones that a first machine takes for toxic; none near another.
With K the landmarks' kernel matrix, a unit's features are K ** -1/2 times its kernel values with the landmarks (Nyström); a
linear machine (squared hinge loss, solved by Newton steps in the primal) is trained on them. Labels are those of whole
texts, so a unit stands on both sides, weighted by the shares of clean and of toxic training texts that have it. Virtual
units with inserted characters are added to the toxic ones.

Scoring. The margin w'K**-1/2 (k(u, z_1), ..) + b is a sum over the subsequences of u with a weight each, so all landmarks
are one table of weights by subsequence, read along a trie; every unit of every text is scored in one narrow pass. A text's
score is a logistic function of its greatest margins, fitted on training texts that the machine has not seen and weighted
to the classes' shares.

What is bounded: at most SAMPLE labelled texts of each class (those with the least hashes of their ids, near copies left
out) train the model; of their units, which Spark counts, the driver gets at most STRONG + COMMON + RANDOM + HARD a round,
of at most WINDOW characters. Nothing else is limited.

Edge cases: null and empty texts have no units, and the score of a text without any; labels that are null or whose id is
null are not used, of repeated labels the greatest counts; repeated rows give repeated results; a null doc_id is never
held out; without a toxic or without a clean training text every score is the share of toxic ones (0 without labels).
An empty table gives an empty one. Only doc_id and text are read. doc_id may have any type for `score`; the query casts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import write_table
from contactloom.llm.units import chunks

#: Texts of each class that train at most.
SAMPLE = 6_000
ORDER, SPAN, DECAY = 4, 7, 0.5
#: Characters of a window of a long unit, and from one to the next.
WINDOW, STEP = 26, 13
#: Units that the driver trains on: those most toxic, the commonest, some at random, and those taken for toxic.
STRONG, COMMON, RANDOM, HARD = 3_000, 1_000, 5_000, 1_500
#: Landmarks of each kind, and margins of a text that count.
TOXIC_MARKS, COMMON_MARKS, HARD_MARKS, TOP = 240, 32, 100, 4
#: A unit that clean and toxic texts have alike leans to clean by this factor.
PRIOR = 6.0
#: The margin of a unit that shares nothing with the landmarks: clean.
BIAS = -1.0
ROUNDS, COST, CLIP = 3, 200.0, 3.0
SLICE = 2 << 20
BEGIN, END = 2, 3
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """(letters and digits, white space) over code points; those beyond the first plane count as letters."""
    letter = np.ones(0x110000, np.bool_)
    letter[: 1 << 16] = np.fromiter((chr(i).isalnum() for i in range(1 << 16)), np.bool_, 1 << 16)
    space = np.zeros(0x110000, np.bool_)
    space[list(SPACES)] = True
    return letter, space


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. , one after another."""
    stop = np.cumsum(size)
    return np.arange(int(stop[-1]) if len(stop) else 0, dtype=np.int64) + np.repeat(start - (stop - size), size)


@dataclass
class Units:
    """Units of some texts: their characters (marks included) one after another, and whose they are."""

    chars: np.ndarray
    size: np.ndarray
    text: np.ndarray

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size

    @cached_property
    def keys(self) -> np.ndarray:
        """64-bit hashes: equal for equal units."""
        if not len(self.size):
            return np.zeros(0, np.uint64)
        power = np.full(WINDOW + 1, 0x9E3779B97F4A7C15, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        return np.add.reduceat((self.chars.astype(np.uint64) + np.uint64(1)) * power[_ranges(np.zeros(len(self.size), np.int64), self.size)], self.starts)

    def strings(self, which: np.ndarray) -> list[str]:
        s = self.starts
        return [self.chars[a : a + n].astype("<u4").tobytes().decode("utf-32-le") for a, n in zip(s[which].tolist(), self.size[which].tolist(), strict=True)]


def units(texts: list[str]) -> Units:
    """All units of all texts."""
    letter, space = _classes()
    low = [t.lower() for t in texts]
    codes = np.frombuffer("".join(x + "\n" for x in low).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
    bound = np.cumsum(np.fromiter(map(len, low), np.int64, len(low)) + 1)
    inside = np.concatenate([[False], ~space[codes], [False]])
    begin, end = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    at = np.flatnonzero(letter[codes])
    if not len(at):
        return Units(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    i, j = np.searchsorted(at, begin), np.searchsorted(at, end)
    some = j > i
    i, j = i[some], j[some]
    begin, end = at[i], at[j - 1] + 1
    size, letters = end - begin, j - i
    text = np.searchsorted(bound, begin, side="right")
    # letters that stand alone join the one before
    single = size == 1
    same = np.zeros(len(begin), np.bool_)
    same[1:] = single[1:] & single[:-1] & (text[1:] == text[:-1])
    unit = np.cumsum(~same) - 1
    whole, whole_text = np.bincount(unit, weights=size).astype(np.int64), text[~same]
    pure = np.flatnonzero(letters < size)  # words with something else inside
    chars = np.concatenate([codes[_ranges(begin, size)], codes[at[_ranges(i[pure], letters[pure])]]])
    return _windows(_marked(chars, np.concatenate([whole, letters[pure]])), np.concatenate([whole_text, text[pure]]))


def _marked(chars: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    full = size + 2
    out = np.full(int(full.sum()), BEGIN, np.int32)
    stop = np.cumsum(full)
    out[stop - 1] = END
    out[_ranges(stop - full + 1, size)] = chars
    return out, full


def _windows(marked: tuple[np.ndarray, np.ndarray], text: np.ndarray) -> Units:
    """Units in the order of their texts; long ones as windows, the last of which ends with the unit."""
    chars, size = marked
    start = np.cumsum(size) - size
    parts = np.maximum(-(-(size - WINDOW) // STEP), 0) + 1
    owner = np.repeat(np.arange(len(size)), parts)
    k = _ranges(np.zeros(len(parts), np.int64), parts)
    begin = start[owner] + np.minimum(k * STEP, np.maximum(size[owner] - WINDOW, 0))
    length = np.minimum(size[owner], WINDOW)
    order = np.argsort(text[owner], kind="stable")
    begin, length = begin[order], length[order]
    return Units(chars[_ranges(begin, length)], length, text[owner][order])


@lru_cache(maxsize=1)
def _norms() -> np.ndarray:
    """sqrt(N(n) + 1) by the unit's size."""
    ways = [(g + 1) * (g + 2) // 2 for g in range(SPAN - ORDER + 1)]  # g gaps dealt over three places
    return np.sqrt([1 + sum(w * DECAY ** (2 * g) * max(n - ORDER + 1 - g, 0) for g, w in enumerate(ways)) for n in range(WINDOW + 1)])


def subsequences(unit: str) -> dict[str, float]:
    """phi of one unit, scaled."""
    out: dict[str, float] = {}
    for i in range(len(unit)):
        for j in range(i + 1, min(i + SPAN, len(unit))):
            for k in range(j + 1, min(i + SPAN, len(unit))):
                for m in range(k + 1, min(i + SPAN, len(unit))):
                    v = unit[i] + unit[j] + unit[k] + unit[m]
                    out[v] = out.get(v, 0.0) + DECAY ** (m - i + 1 - ORDER)
    norm = float(_norms()[len(unit)])
    return {v: x / norm for v, x in out.items()}


class Weights:
    """A function of units that sums a weight for each place of a subsequence, read along a trie of its characters."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.bias = bias
        letters = sorted({c for v in weights for c in v})
        number = {c: i + 1 for i, c in enumerate(letters)}
        self.letter = np.zeros(max(map(ord, letters), default=0) + 1, np.int32)
        for c, i in number.items():
            self.letter[ord(c)] = i
        n = len(letters) + 1
        two: dict[tuple, int] = {}
        three: dict[tuple, int] = {}
        last = []
        for v, w in weights.items():
            a, b, c, d = (number[x] for x in v)
            p = two.setdefault((a, b), len(two) + 1)
            q = three.setdefault((p, c), len(three) + 1)
            last.append((q, d, w))
        self.two = np.zeros((n, n), np.int32)
        self.three = np.zeros((len(two) + 1, n), np.int32)
        self.four = np.zeros((len(three) + 1, n), np.float32)
        for (a, b), p in two.items():
            self.two[a, b] = p
        for (p, c), q in three.items():
            self.three[p, c] = q
        for q, d, w in last:
            self.four[q, d] = w

    def __call__(self, u: Units) -> np.ndarray:
        """The value of each unit; equal ones are worked out once."""
        _, first, place = np.unique(u.keys, return_index=True, return_inverse=True)
        return self.values(Units(u.chars[_ranges(u.starts[first], u.size[first])], u.size[first], u.text[first]))[place]

    def values(self, u: Units) -> np.ndarray:
        n = len(u.chars)
        if not n or len(self.two) == 1:
            return np.full(len(u.size), self.bias)
        x = self.letter[np.minimum(u.chars, len(self.letter) - 1)]
        x[u.chars >= len(self.letter)] = 0
        owner = np.repeat(np.arange(len(u.size)), u.size)
        left = np.repeat(np.cumsum(u.size), u.size) - np.arange(n)  # characters from here to the unit's end
        total = np.zeros(len(u.size))
        for j in range(1, SPAN - 2):
            node = self.two[x[: n - j], x[j:]]
            first = np.flatnonzero((node > 0) & (left[: n - j] > j))
            node = node[first]
            for k in range(j + 1, SPAN - 1):
                some = left[first] > k
                p = first[some]
                deep = self.three[node[some], x[p + k]]
                on = deep > 0
                p, deep = p[on], deep[on]
                for m in range(k + 1, SPAN):
                    ok = left[p] > m
                    q = p[ok]
                    got = self.four[deep[ok], x[q + m]]
                    total += np.bincount(owner[q], weights=got * DECAY ** (m + 1 - ORDER), minlength=len(total))
        return total / _norms()[u.size] + self.bias


def greatest(u: Units, values: np.ndarray, floor: float, n_texts: int, k: int) -> np.ndarray:
    """The k greatest values of each text over its different units, as if it had k empty units (of value `floor`) more."""
    best = np.full((n_texts, k), floor)
    at = np.flatnonzero(values > floor)
    if len(at):
        text, h = u.text[at], u.keys[at]
        order = np.lexsort((h, -values[at], text))
        order = order[np.concatenate([[True], (np.diff(text[order]) != 0) | (np.diff(h[order]) != 0)])]
        text = text[order]
        rank = np.arange(len(order)) - np.searchsorted(text, text, side="left")
        some = rank < k
        best[text[some], rank[some]] = values[at][order[some]]
    return best


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, clean, toxic): in how many of a slice's texts each unit is."""
    for batch in batches:
        for rows in chunks(batch, limit=SLICE):
            u = units(rows.column("text").to_pylist())
            if not len(u.size):
                continue
            toxic = rows.column("toxic").to_numpy(zero_copy_only=False) > 0
            _, first, place = np.unique(u.keys, return_index=True, return_inverse=True)
            pair = np.unique(place.astype(np.int64) * rows.num_rows + u.text)
            unit, bad = pair // rows.num_rows, toxic[pair % rows.num_rows]
            counts = [np.bincount(unit[x], minlength=len(first)) for x in (~bad, bad)]
            yield pa.RecordBatch.from_arrays([pa.array(u.strings(first), pa.string()), *(pa.array(c, pa.int64()) for c in counts)], ["unit", "clean", "toxic"])


def _valued(batches: Iterator[pa.RecordBatch], model: Weights) -> Iterator[pa.RecordBatch]:
    """Rows of counted units with the model's value."""
    for batch in batches:
        names = batch.column("unit").to_pylist()
        size = np.fromiter(map(len, names), np.int64, len(names))
        u = Units(np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32), size, np.zeros(len(names), np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.values(u), pa.float64())], [*batch.schema.names, "value"])


def _margins(batches: Iterator[pa.RecordBatch], model: Weights) -> Iterator[pa.RecordBatch]:
    """(toxic, margins): each text's TOP greatest margins."""
    for batch in batches:
        for rows in chunks(batch, limit=SLICE):
            u = units(rows.column("text").to_pylist())
            best = greatest(u, model(u), model.bias, rows.num_rows, TOP)
            yield pa.RecordBatch.from_arrays([rows.column("toxic"), pa.array(list(best), pa.list_(pa.float64()))], ["toxic", "margins"])


def kernel(a: list[dict[str, float]], b: list[dict[str, float]]) -> np.ndarray:
    """Kernel values between units, given as scaled subsequences."""
    place: dict[str, int] = {}
    for z in b:
        for v in z:
            place.setdefault(v, len(place))
    table = np.zeros((len(place), len(b)))
    for j, z in enumerate(b):
        table[[place[v] for v in z], j] = list(z.values())
    out = np.zeros((len(a), len(b)))
    for i, u in enumerate(a):
        hit = [v for v in u if v in place]
        if hit:
            out[i] = np.array([u[v] for v in hit]) @ table[[place[v] for v in hit]]
    return out


def inserted(unit: str, rng: np.random.Generator) -> str:
    """The unit with one to two characters put in between its letters."""
    out = list(unit)
    for _ in range(int(rng.integers(1, 3))):
        out.insert(int(rng.integers(2, max(len(out) - 1, 3))), "*-.x_e1"[int(rng.integers(7))])
    return "".join(out)[:WINDOW]


def train_machine(x: np.ndarray, clean: np.ndarray, toxic: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights w of the machine x @ w + BIAS, each row being clean and toxic by these weights: squared hinge loss, Newton steps
    over what is inside the margin, each halved until the loss falls."""

    def loss(w: np.ndarray, f: np.ndarray) -> float:
        return float(w @ w + toxic @ np.maximum(1 - f, 0) ** 2 + clean @ np.maximum(1 + f, 0) ** 2)

    w = np.zeros(x.shape[1])
    f = x @ w + BIAS
    now = loss(w, f)
    for _ in range(steps):
        up, down = toxic * (f < 1), clean * (f > -1)
        bend, slope = np.eye(len(w)), x.T @ (up * (1 - BIAS) + down * (-1 - BIAS))
        for i in range(0, len(x), 2048):  # by parts, to bound memory
            bend += (x[i : i + 2048] * (up + down)[i : i + 2048, None]).T @ x[i : i + 2048]
        step = np.linalg.solve(bend, slope) - w
        size = 1.0
        while (then := loss(w + size * step, x @ (w + size * step) + BIAS)) >= now and size > 1e-6:
            size /= 2
        if then >= now * (1 - 1e-7):
            break
        w, now = w + size * step, then
        f = x @ w + BIAS
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights and, last, bias, by Newton steps with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    total = weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) / total - 1e-4 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x / total + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 4.0 / max(float(np.abs(step).max()), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence(margins: np.ndarray) -> np.ndarray:
    """Of each text's TOP greatest margins: the sum of those above zero, each clipped, so that one clear unit or several weaker
    ones tell; and how far the greatest is below zero."""
    return np.column_stack([np.clip(margins, 0, CLIP).sum(1), np.minimum(margins[:, 0], 0)])


@dataclass
class Model:
    """margin: of a unit; logistic: over `evidence`, and a bias."""

    margin: Weights
    logistic: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        u = units(texts)
        best = greatest(u, self.margin(u), self.margin.bias, len(texts), TOP)
        return 1 / (1 + np.exp(-(evidence(best) @ self.logistic[:-1] + self.logistic[-1])))


def _constant(share: float) -> Model:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return Model(Weights({}, 0.0), np.array([0.0, 0.0, np.log(share / (1 - share))]))


def _spaced(units_: list[str], n: int, taken: list[dict[str, float]], near: float = 0.9) -> list[str]:
    """The first n that are not near each other or those taken."""
    out: list[str] = []
    holders: dict[str, list[tuple[int, float]]] = {}

    def put(i: int, z: dict[str, float]) -> None:
        for v, x in z.items():
            holders.setdefault(v, []).append((i, x))

    for i, z in enumerate(taken):
        put(i, z)
    for name in units_:
        if len(out) == n:
            break
        z = subsequences(name)
        like: dict[int, float] = {}
        for v, x in z.items():
            for i, y in holders.get(v, ()):
                like[i] = like.get(i, 0.0) + x * y
        if z and max(like.values(), default=0.0) < near * sum(x * x for x in z.values()):
            put(len(taken), z)
            taken.append(z)
            out.append(name)
    return out


def sketches(texts: list[str]) -> np.ndarray:
    """Of each text, the least hash of five following units (of fewer, where it has no more): that of near copies is mostly the
    same. Texts without units share one."""
    u = units(texts)
    out = np.full(len(texts), np.iinfo(np.int64).max)
    n = len(u.size)
    if n:
        left = np.searchsorted(u.text, u.text, side="right") - np.arange(n)  # units from here to the text's end
        h = np.zeros(n, np.uint64)
        for k in range(5):
            some = np.flatnonzero(left > k)
            h[some] = (h[some] + u.keys[some + k]) * np.uint64(0x9E3779B97F4A7C15)
            h[some] ^= h[some] >> np.uint64(29)
        first = np.flatnonzero(np.diff(u.text, prepend=-1))
        whole = (left >= 5) | (np.repeat(left[first], left[first]) < 5)
        np.minimum.at(out, u.text[whole], (h[whole] >> np.uint64(1)).astype(np.int64))
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in chunks(batch, limit=SLICE):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(sketches(rows.column("text").to_pylist()), pa.int64())], [*rows.schema.names, "sketch"])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic), both of training rows only."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = docs.select("doc_id").distinct().join(known, "doc_id")
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return _constant(float(bool(totals.get(1))))
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    chosen = known.filter("toxic = 0").orderBy(order, "doc_id").limit(sample).unionByName(known.filter("toxic = 1").orderBy(order, "doc_id").limit(sample))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most 2 * sample rows
    rows = rows.select("text", "toxic").mapInArrow(_sketched, "text string, toxic int, sketch long")
    rows = rows.groupBy("toxic", "sketch").agg(F.min("text").alias("text"))
    rows = write_table(spark, rows.select("text", "toxic", (F.pmod("sketch", F.lit(4)) == 0).alias("judged")), "labelled")
    n = {r.toxic: (r.n, r.judged) for r in rows.groupBy("toxic").agg(F.count("*").alias("n"), F.count_if("judged").alias("judged")).collect()}
    # too few to keep some for the logistic function: all serve for both
    apart = all(j >= 20 and m - j >= 20 for m, j in n.values())
    learning, judging = (rows.filter("not judged"), rows.filter("judged")) if apart else (rows, rows)
    n_learn = {k: m - j if apart else m for k, (m, j) in n.items()}

    counted = write_table(spark, learning.mapInArrow(_counted, "unit string, clean long, toxic long").groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "units")
    odds = F.log((F.col("toxic") + 0.5) / (n_learn[1] + 1) / ((F.col("clean") + 0.5) / (n_learn[0] + 1)))

    def some(df: DataFrame, by: Column, most: int) -> list[tuple[str, int, int]]:
        return [tuple(r) for r in df.orderBy(by, "unit").limit(most).select("unit", "clean", "toxic").collect()]

    strong = some(counted.filter("toxic > 1").withColumn("strength", F.col("toxic") * odds).filter("strength > 0"), F.desc("strength"), STRONG)
    common, random = some(counted, F.desc("clean"), COMMON), some(counted, F.xxhash64("unit"), RANDOM)

    def hard(model: Weights) -> list[tuple[str, int, int]]:
        return some(counted.mapInArrow(lambda it: _valued(it, model), "unit string, clean long, toxic long, value double").filter("clean > 0"), F.desc("value"), HARD)

    if not strong:
        return _constant(totals[1] / sum(totals.values()))
    margin = learn(strong, common, random, hard, n_learn)
    margins = judging.mapInArrow(lambda it: _margins(it, margin), "toxic int, margins array<double>").collect()
    weight = {k: totals[k] / (n[k][1] if apart else n[k][0]) for k in totals}
    y = np.array([float(r.toxic) for r in margins])
    return Model(margin, fit_logistic(evidence(np.array([r.margins for r in margins])), y, np.array([weight[r.toxic] for r in margins])))


Counted = list[tuple[str, int, int]]


def learn(strong: Counted, common: Counted, random: Counted, hard: Callable[[Weights], Counted], n: dict[int, int]) -> Weights:
    """The machine, from units with the numbers of clean and of toxic texts that have them: those that go with toxic texts
    (strongest first), the commonest ones, some at random, and those clean ones that a first machine takes for toxic."""
    taken: list[dict[str, float]] = []
    marks: list[str] = []
    rng = np.random.default_rng(11)
    model, found = None, {}

    def add(names: list[str], most: int) -> None:
        marks.extend(_spaced(names, most, taken))

    add([u for u, *_ in strong[: 4 * TOXIC_MARKS]], TOXIC_MARKS)
    add([u for u, *_ in common[: 4 * COMMON_MARKS]], COMMON_MARKS)
    found.update((u, (c, t)) for u, c, t in strong + common + random)
    for k in range(ROUNDS):
        if k:
            more = hard(model)
            found.update((u, (c, t)) for u, c, t in more)
            add([u for u, *_ in more[: 4 * HARD_MARKS]], HARD_MARKS)
        root = _inverse_root(kernel(taken, taken))
        names = list(found)
        clean, toxic = (np.array([found[u][i] for u in names], float) for i in (0, 1))
        good, bad = clean / n[0] * PRIOR, toxic / n[1]
        # names begin with the strongest
        virtual = [(i, inserted(names[i], rng)) for i in np.flatnonzero(bad > 2 * good).tolist() for _ in range(8 if i < 64 else 1)]
        everyone = names + [u for _, u in virtual]
        blocks = [kernel([subsequences(u) for u in everyone[i : i + 1024]], taken) @ root for i in range(0, len(everyone), 1024)]
        # the commonest words weigh no more than the ten strongest, lest they decide all
        scale = COST / np.median((good + bad)[toxic > 1]) * np.minimum(1, np.median(bad[:10]) / (good + bad))
        owner = [i for i, _ in virtual]
        w = train_machine(np.concatenate(blocks), np.append(scale * good, np.zeros(len(virtual))), np.append(scale * bad, 0.5 * (scale * bad)[owner]))
        model = _collapsed(marks, root @ w, BIAS)
    return model


def _inverse_root(k: np.ndarray) -> np.ndarray:
    value, vector = np.linalg.eigh(k)
    return (vector / np.sqrt(np.maximum(value, 1e-3))) @ vector.T


def _collapsed(marks: list[str], alpha: np.ndarray, bias: float) -> Weights:
    """sum_j alpha_j k(u, z_j) + bias as weights of subsequences."""
    total: dict[str, float] = {}
    for z, a in zip(marks, alpha.tolist(), strict=True):
        for v, x in subsequences(z).items():
            total[v] = total.get(v, 0.0) + a * x
    return Weights(total, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of all rows of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in chunks(batch, limit=SLICE):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(model.scores(rows.column("text").to_pylist()), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every whole document scored by a model of the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    model = fit(spark, docs.filter(~is_held_out()), labels.filter(~is_held_out()))
    return score(docs, model).select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
