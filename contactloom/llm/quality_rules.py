"""Quality rules: counts of words, symbols and repeats, and divergence from a language's usual histograms.

`features` is row-local (SQL functions only). For each document it holds two histograms: shares of character classes,
and shares of a language's common words. A language's reference is the mean histogram of its long enough documents,
over the whole corpus (`references`: one row a language of a fixed list, so it is safe to broadcast). `judge` rejects
a document whose Jensen-Shannon distance from its reference is too large; no histogram of a short document is judged.

Edge cases: a null text has no words; an unknown or null language has the reference of all such documents and no
common words; with no words a document fails the base rules (under 10 words). Other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import write_table

#: Some of the most frequent words of each language.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "des", "auf"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
OTHER = "_other"
#: Character classes, taken off the text one after another; the rest are characters beyond ASCII.
CHAR_CLASSES = (
    ("lower", r"[a-z]+"),
    ("space", r"[\x20\x09-\x0D]+"),
    ("upper", r"[A-Z]+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("digit", r"[0-9]+"),
    ("punct", r"[\x00-\x7F]+"),
)
CODES = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Common words of all languages, each once.
EVERY = sorted({w for ws in COMMON.values() for w in ws})
WHITE = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    repeat_percent: int = 20
    window: int = 5
    #: Documents under these sizes aren't judged by divergence.
    judge_chars: int = 200
    judge_words: int = 60
    #: Jensen-Shannon distances (roots of divergences in bits, 0 to 1).
    max_char_distance: float = 0.30
    max_word_distance: float = 0.55
    #: Hold words against those common in any language, at this share of the distance that a text without any has from
    #: its reference (see `judge`). None: against those of the text's own language, at max_word_distance.
    word_reach: float | None = None

    #: Guard the histogram of characters by characters only and that of words by words only, instead of each by both.
    apart: bool = False

    @property
    def n_common(self) -> int:
        return 12 if self.word_reach is None else len(EVERY)


#: What the pipeline and the registered query drop by.
PIPELINE = Limits(word_reach=0.85, apart=True)


def _repeats(w: Column, size: int) -> Column:
    """Words inside windows of `size` words that occur at least twice, by 64-bit hashes of the windows."""

    def counted(h: Column) -> Column:
        keyed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def places(s: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
            ids = F.sequence(F.lit(0), F.size(s) - 1)
            return F.array_sort(F.transform(F.filter(ids, lambda i: same(i, i - 1) | same(i, i + 1)), lambda i: F.get(s, i)["p"]))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        covered = F.aggregate(
            F.transform(F.array(keyed), places)[0],
            zero,
            lambda acc, p: F.struct((p + size).alias("end"), (acc["n"] + size - F.greatest(acc["end"] - p, F.lit(0))).alias("n")),
            lambda acc: acc["n"],
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])
    )
    return F.when(F.size(w) > size, F.transform(F.array(hashes), counted)[0]).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """docs with one more column, `_q`: the counts and histograms of each row."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = [F.col(f"`{c}`") for c in docs.columns]
    known = F.when(F.col(lang).isin(*COMMON), F.col(lang)).otherwise(F.lit(OTHER))
    df = docs.select(
        *names,
        known.alias("_lang"),
        F.length(t).alias("_len"),
        F.filter(F.split(t, r"[\x20\x09-\x0D]+", -1), lambda x: x != "").alias("_w"),
        F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0).alias("_lines"),
        F.regexp_replace(t, CHAR_CLASSES[0][1], "").alias("_r0"),
    )
    for i, (_, pattern) in enumerate(CHAR_CLASSES[1:], 1):
        df = df.select("*", F.regexp_replace(f"_r{i - 1}", pattern, "").alias(f"_r{i}"))
    if limits.word_reach is None:
        words, lists = F.col("_w"), F.lit(None).cast("array<string>")
        for k, ws in COMMON.items():
            lists = F.when(F.col("_lang") == k, F.array(*map(F.lit, ws))).otherwise(lists)
    else:
        most = max(map(len, EVERY))
        words, lists = F.filter("_w", lambda x: F.length(x) <= most), F.array(*map(F.lit, EVERY))
    df = df.withColumn("_common", lists)
    at = F.transform(words, lambda x: F.array_position(F.col("_common"), x).cast("int"))
    codes = F.array_join(F.transform(F.filter(at, lambda p: p > 0), lambda p: F.substring(F.lit(CODES), p, F.lit(1))), "")
    df = df.withColumn("_codes", F.coalesce(codes, F.lit("")))
    lens = [F.col("_len"), *[F.length(f"_r{i}") for i in range(len(CHAR_CLASSES))]]
    chars = [a - b for a, b in zip(lens, lens[1:], strict=False)] + [lens[-1]]
    n_codes = F.length("_codes")
    per_word = [n_codes - F.length(F.replace("_codes", F.lit(c), F.lit(""))) for c in CODES[: limits.n_common]]
    n_words = F.size("_w")
    q = F.struct(
        F.col("_lang").alias("lang"),
        F.col("_len").alias("n_chars"),
        n_words.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        chars[3].cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeats(F.col("_w"), limits.window).alias("n_repeat_words"),
        F.array(*[c.cast("double") / F.greatest(F.col("_len"), F.lit(1)) for c in chars]).alias("char_share"),
        F.array(*[c.cast("double") / F.greatest(n_words, F.lit(1)) for c in [*per_word, n_words - n_codes]]).alias("word_share"),
    )
    return df.select(*names, q.alias("_q"))


def _long(limits: Limits) -> tuple[Column, Column]:
    """Whether a text is long enough for its histogram of characters, and of words."""
    chars, words = F.col("_q.n_chars") >= limits.judge_chars, F.col("_q.n_words") >= limits.judge_words
    return (chars, words) if limits.apart else (chars & words, chars & words)


def references(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(lang, ref_chars, ref_words): mean histograms of the long enough documents; at most one row a known language."""
    n, m = len(CHAR_CLASSES) + 1, limits.n_common + 1
    chars, words = _long(limits)
    means = rows.filter(chars | words).groupBy(F.col("_q.lang").alias("lang")).agg(
        F.array(*[F.round(F.avg(F.when(chars, F.col("_q.char_share")[i])), 9) for i in range(n)]).alias("ref_chars"),
        F.array(*[F.round(F.avg(F.when(words, F.col("_q.word_share")[i])), 9) for i in range(m)]).alias("ref_words"),
    )
    return means


def _distance(p: Column, q: Column, n: int) -> Column:
    """Jensen-Shannon distance of two histograms of n shares: the root of the divergence in bits."""

    def term(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    total = F.lit(0.0)
    for i in range(n):
        total = total + term(p[i], q[i]) + term(q[i], p[i])
    return F.round(F.sqrt(F.greatest(total / 2, F.lit(0.0))), 6)


def judge(rows: DataFrame, refs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """rows (of `features`) with base_failed, char_distance, word_distance (null where not judged) and kept.

    With word_reach, a text's words are too far at that share of the distance at which a text without common words
    would be: clean texts end below, gibberish is at 1, and common words of another language add to it. A reference
    without common words judges none.
    """
    names = [F.col(f"`{c}`") for c in rows.columns]
    got = rows.join(F.broadcast(refs.withColumnRenamed("lang", "_ref")), F.col("_q.lang") == F.col("_ref"), "left")
    q = lambda k: F.col(f"_q.{k}")
    chars, words = _long(limits)
    failed = (q("n_words") < limits.min_words) | (100 * q("n_repeat_words") > limits.repeat_percent * q("n_words"))
    n_shares = limits.n_common + 1
    edge = F.lit(limits.max_word_distance)
    if limits.word_reach is not None:
        bare = [F.lit(0.0)] * limits.n_common + [F.lit(1.0)]  # a text without common words
        bare = _distance(bare, F.col("ref_words"), n_shares)
        edge = F.when(bare > 0, limits.word_reach * bare).otherwise(F.lit(1.0))
    got = got.select(
        *names,
        failed.alias("base_failed"),
        F.when(chars, _distance(q("char_share"), F.col("ref_chars"), len(CHAR_CLASSES) + 1)).alias("char_distance"),
        F.when(words & (q("lang") != OTHER), _distance(q("word_share"), F.col("ref_words"), n_shares)).alias("word_distance"),
        edge.alias("_edge"),
    )
    far = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > limits.max_char_distance) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > F.coalesce(F.col("_edge"), F.lit(1.0))
    )
    return got.withColumn("kept", ~F.col("base_failed") & ~far).drop("_edge")


def keep_good(spark: SparkSession, docs: DataFrame, limits: Limits = PIPELINE) -> DataFrame:
    """The rows of docs that pass all rules, with docs' columns."""
    hidden = {c: f"_x{i}" for i, c in enumerate(docs.columns)}  # so that no column clashes with those of judge
    plain = docs.toDF(*hidden.values())
    rows = write_table(spark, features(plain, hidden["text"], hidden["lang"], limits), "quality")
    kept = judge(rows, references(rows, limits), limits).filter("kept")
    return kept.select(*[F.col(h).alias(c) for c, h in hidden.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: counts and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = write_table(spark, features(docs, limits=PIPELINE).select("doc_id", "_q"), "quality")
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judge(rows, references(rows, PIPELINE), PIPELINE).select(
        "doc_id", *[F.col(f"_q.{c}") for c in out], "base_failed", "kept", "char_distance", "word_distance"
    )
