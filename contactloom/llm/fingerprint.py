"""Document fingerprints by winnowing: rolling k-gram hashes, the least of every window, the rightmost of equals, and
their positions.

The k-grams are those of the text's UTF-8 bytes. The hash is the cyclic polynomial over 64 bits: with T a random number
for each byte and P the running exclusive-or of T[b[j]] rotated by -j, the hash of b[j:j+k] is P[j+k] ^ P[j], rotated
back; so each byte costs one update, whatever k is. In every window of `window` successive hashes the least is
selected. A hash loses its lowest seven bits to the inverted place inside its block, so that the least number is the
least hash at its rightmost place. Two texts that share `window + k - 1` bytes share a selected hash, and positions say
where.

A text is cut to blocks of 95 windows, and each block is a row, whose bytes, hashes and minima are columns: Catalyst
compiles them to straight code on machine words. Minima take three comparisons a place (running minima from both sides
of every 16th place). The blocks of a row go together again in the task that made them.

The edited text is the first half of a row's text and the first part of the next one's, so its fingerprint is made of
blocks of both, and only the windows where they meet, and the last ones, are new.

Edge cases: doc_id is cast to long (an id that is no number fails or is null, by Spark's ANSI setting); a null text counts as empty; an empty text selects nothing (empty fingerprint); a text of under k bytes
is one k-gram; two empty fingerprints are alike (1.0), an empty and another one are not (0.0); equal keys go by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactloom.llm.common import parallelism

K, WINDOW = 16, 32
#: New windows of a block, its k-grams (with those of one window before), its bytes. Columns over 100 a row keep Spark
#: from fusing the steps to one method, which would be too large for the JVM's compiler.
BLOCK = 95
GRAMS = BLOCK + WINDOW
BYTES = GRAMS + K - 1
REACH = WINDOW + K - 2
PLACE = 7
LOW = (1 << PLACE) - 1
NONE = (1 << 63) - 1


def rotate(x: str, by: int) -> str:
    """SQL for x rotated to the left."""
    by %= 64
    return f"(shiftleft({x}, {by}) | shiftrightunsigned({x}, {64 - by}))" if by else x


def _n_windows(n_bytes: Column) -> Column:
    return F.when(n_bytes > 0, F.greatest(n_bytes - REACH, F.lit(1))).otherwise(0)


def _n_blocks(windows: Column) -> Column:
    return F.ceil(F.greatest(windows, F.lit(0)) / BLOCK).cast("int")


def select(rows: DataFrame, keep: list[str]) -> DataFrame:
    """rows[keep] with `chosen`, the distinct minima of the windows of a block, in order of place.

    rows: piece (binary, at most BYTES bytes), valid (int, how many windows count), head (whether the text begins here;
    then its first k-gram may be short, else the first window is the last one of the block before, and what it selects
    is left out).
    """
    names = [*keep, "valid", "head", "_len"]
    byte = [f"_c{j}" for j in range(BYTES)]
    # a read of a binary column copies it, so bytes are read from short ones
    df = rows.selectExpr(*keep, "valid", "head", "octet_length(piece) AS _len", *[f"substring(piece, {at + 1}, {K}) AS _s{at}" for at in range(0, BYTES, K)])
    df = df.selectExpr(*names, "0L AS _p0", *[f"xxhash64(substring(_s{j // K * K}, {j % K + 1}, 1)) AS {c}" for j, c in enumerate(byte)])
    for at in range(0, BYTES, K):
        stop, now, made = min(at + K, BYTES), f"_p{at}", []
        for j in range(at, stop):
            now = f"{now} ^ {rotate(byte[j], -j)}"
            made.append(f"{now} AS _p{j + 1}")
        df = df.selectExpr(*names, *[f"_p{j}" for j in range(at + 1)], *made, *byte[stop:])
    # a k-gram that the piece does not hold whole is none, but for that of a short text
    hashes = [
        f"CASE WHEN _len >= {j + K}{' OR head' if j == 0 else ''} THEN {rotate(f'(_p{j + K} ^ _p{j})', j + K - 1)} & {~LOW}L | {LOW - j}L ELSE {NONE}L END AS _h{j}"
        for j in range(GRAMS)
    ]
    df = df.selectExpr(*names, *hashes)
    ahead, behind = [""] * GRAMS, [""] * GRAMS  # the least from the last 16th place on, and up to the next one
    for j in range(GRAMS):
        ahead[j] = f"_h{j}" if j % WINDOW == 0 else f"least({ahead[j - 1]}, _h{j})"
    for j in reversed(range(GRAMS)):
        behind[j] = f"_h{j}" if j % WINDOW == WINDOW - 1 or j == GRAMS - 1 else f"least(_h{j}, {behind[j + 1]})"
    least = [behind[o] if o % WINDOW == 0 else f"least({behind[o]}, {ahead[o + WINDOW - 1]})" for o in range(BLOCK + 1)]
    return df.selectExpr(*keep, f"slice(array_distinct(slice(array({', '.join(least)}), 1, valid)), if(head, 1, 2), {BLOCK}) AS chosen")


#: A fingerprint: the selected hashes and their places in the text.
KIND = "struct<hashes:array<bigint>,places:array<int>>"


def _hashes(blocks: Column) -> Column:
    return F.flatten(F.transform(blocks, lambda b: F.transform(b, lambda v: F.shiftright(v, PLACE))))


def _places(blocks: Column, start: Column, from_zero: bool = True) -> Column:
    """Places of what successive blocks selected; the first one starts at `start`."""
    low = F.lit(LOW).cast("long")

    def one(b: Column, i: Column) -> Column:
        at = start + i * BLOCK - F.when((i == 0) & (start == 0) if from_zero else i == 0, 0).otherwise(1)
        return F.transform(b, lambda v: (at + low - v.bitwiseAND(low)).cast("int"))

    return F.flatten(F.transform(blocks, one))


def as_text(fingerprint: Column) -> Column:
    """The hashes by single spaces, @, and their places likewise."""
    return F.concat_ws("@", *[F.array_join(fingerprint[x].cast("array<string>"), " ") for x in ("hashes", "places")])


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of hashes."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(1.0)


def in_order(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Window]:
    """Rows (key, text, bucket, tail) and a window over which lead() is the next row by descending key, cyclic.

    Keys are cut into ranges by approximate quantiles; a window never spans ranges, and rows of a repeated key share one,
    so very many rows of one key are one task. The first row of the following range is added to each range as a tail row (drop it afterwards).
    Nulls come last, equal keys go by text.
    """
    null = -(1 << 63)
    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text))
    n = 4 * parallelism(spark)
    k = F.coalesce(F.col(key), F.lit(null))
    cuts = rows.agg(F.percentile_approx(k, [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    bounds = sorted(set(map(int, cuts)))
    # bisection: the number of bounds under the key
    lo = F.lit(0)
    steps = 1 << max(0, len(bounds).bit_length() - 1) if bounds else 0
    array = F.array(*[F.lit(c).cast("long") for c in bounds]) if bounds else None
    halves = F.array(*[F.lit(steps >> i) for i in range(steps.bit_length())]) if bounds else None
    if bounds:
        lo = F.aggregate(halves, F.lit(0), lambda acc, step: F.when(F.coalesce(F.get(array, acc + step - 1) < k, F.lit(False)), acc + step).otherwise(acc))
    rows = rows.withColumn("bucket", lo)
    first = F.struct((-F.lit(1) * F.greatest(k, F.lit(null + 1))).alias("a"), F.col(text).alias("b"))
    heads = rows.groupBy("bucket").agg(F.max(k).alias("head")).collect()  # one row a bucket
    heads.sort()
    after = [(heads[i]["bucket"], heads[i - 1]["head"]) for i in range(len(heads))]  # the lowest is followed by the highest
    to = spark.createDataFrame(after, "_to int, _head long")
    tops = rows.join(F.broadcast(to), k == F.col("_head")).groupBy("_to").agg(F.min_by(F.struct(key, text), first).alias("x"))
    tails = tops.select(F.col(f"x.{key}").alias(key), F.col(f"x.{text}").alias(text), F.col("_to").alias("bucket"), F.lit(True).alias("tail"))
    both = rows.select(key, text, "bucket", F.lit(False).alias("tail")).unionByName(tails)
    return both, Window.partitionBy("bucket").orderBy("tail", F.col(key).desc_nulls_last(), text)


def fingerprints(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, own, edited, near_edited, near_next) of every row of docs (key, text).

    own and edited are of KIND: the fingerprints of the text and of the text whose second half is
    replaced by the beginning of the next row's.
    """
    rows, w = in_order(spark, docs, key, text)
    t, n = F.col(text), F.length(text)
    half = F.floor(n / 2).cast("int")
    df = rows.select("*", F.row_number().over(w).alias("_row"), F.coalesce(F.lead(text).over(w), F.lit("")).alias("_next"))
    df = df.select(
        key, "bucket", "tail", "_row", n.cast("long").alias("n_chars"), t.cast("binary").alias("_own"),
        F.substring(t, F.lit(1), n - half).cast("binary").alias("_a"), F.substring("_next", F.lit(1), half).cast("binary").alias("_b"),
    )
    m, q = F.octet_length("_a"), F.octet_length("_b")
    df = df.select("*", F.concat("_a", "_b").alias("_e"), m.alias("_m"), _n_windows(F.octet_length("_own")).alias("_w"), _n_windows(m + q).alias("_we"), *[
        F.greatest(F.floor((x - REACH) / BLOCK), F.lit(0)).cast("int").alias(name) for x, name in ((m, "_n1"), (q, "_n2"))  # whole blocks of both parts
    ])
    junction, last = F.least("_m", "_we"), F.col("_m") + F.col("_n2") * BLOCK
    df = df.select("*", F.sha2("_e", 256).alias("edited_sha256"), _n_blocks(F.col("_w")).alias("_k0"), _n_blocks(junction - F.col("_n1") * BLOCK).alias("_k1"), _n_blocks(F.col("_we") - last).alias("_k2")).drop("_a", "_b")
    total = F.col("_k0") + F.col("_k1") + F.col("_k2")
    numbers = F.when(total > 0, F.sequence(F.lit(0), total - 1))
    tag = ["bucket", "_row", "tail", key, "n_chars", "edited_sha256", "_m", "_n1", "_n2", "_k0", "_k1"]
    df = df.select(*tag, "_own", "_e", "_w", "_we", F.explode_outer(numbers).alias("_i"))
    i = F.col("_i")
    mine, meeting = i < F.col("_k0"), i < F.col("_k0") + F.col("_k1")
    off = F.when(mine, i * BLOCK).when(meeting, (F.col("_n1") + i - F.col("_k0")) * BLOCK).otherwise(last + (i - F.col("_k0") - F.col("_k1")) * BLOCK)
    limit = F.when(mine, F.col("_w")).when(meeting, junction).otherwise(F.col("_we"))
    df = df.select(*tag, "_i", off.alias("_off"), F.least(F.lit(BLOCK), limit - off).alias("_valid"), F.when(mine, F.col("_own")).otherwise(F.col("_e")).alias("_src"))
    skip = F.when(F.col("_off") > 0, 1).otherwise(0)
    df = df.select(*tag, "_i", F.substring("_src", F.col("_off") + 1 - skip, F.lit(BYTES)).alias("piece"), F.greatest(F.col("_valid") + skip, F.lit(0)).cast("int").alias("valid"), (skip == 0).alias("head"))
    chosen = select(df, [*tag, "_i"])
    got = chosen.groupBy("bucket", "_row").agg(
        *[F.first(c).alias(c) for c in tag[2:]], F.sort_array(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct("_i", "chosen")))).alias("_x")
    )
    blocks = F.transform("_x", lambda x: x["chosen"])
    got = got.select(*tag, blocks.alias("_all"))
    got = got.select(*tag, F.slice("_all", F.lit(1), F.col("_k0")).alias("_blocks"), F.slice("_all", F.col("_k0") + 1, F.col("_k1")).alias("_j"), F.slice("_all", F.col("_k0") + F.col("_k1") + 1, F.lit(2)).alias("_z"))
    none = F.expr("cast(array() as array<array<bigint>>)")
    got = got.select("*", F.coalesce(F.lead("_blocks").over(Window.partitionBy("bucket").orderBy("_row")), none).alias("_then")).filter(~F.col("tail"))
    first, joint, then, rest = F.slice("_blocks", F.lit(1), F.col("_n1")), F.col("_j"), F.slice("_then", F.lit(1), F.col("_n2")), F.col("_z")
    zero = F.lit(0)
    whole = F.struct(_hashes(F.col("_blocks")).alias("hashes"), _places(F.col("_blocks"), zero).alias("places"))
    front = F.struct(_hashes(F.concat(first, joint)).alias("hashes"), _places(F.concat(first, joint), zero).alias("places"))
    middle = F.struct(_hashes(then).alias("hashes"), _places(then, F.col("_m"), False).alias("places"))
    back = F.struct(_hashes(rest).alias("hashes"), _places(rest, F.col("_m") + F.col("_n2") * BLOCK - 1, False).alias("places"))
    # where the other text begins, its first window may select what the last one before it does
    both = F.try_element_at("_front.places", F.lit(-1)) == F.get("_middle.places", F.lit(0))
    cut = F.when(F.coalesce(both, F.lit(False)), 2).otherwise(1)
    got = got.select(key, "n_chars", "edited_sha256", whole.alias("own"), front.alias("_front"), middle.alias("_middle"), back.alias("_back"), _hashes(F.col("_then")).alias("_following"))
    join = lambda x: F.concat(F.col(f"_front.{x}"), F.slice(f"_middle.{x}", cut, F.lit(NONE >> 32)), F.col(f"_back.{x}")).alias(x)
    got = got.select(key, "n_chars", "edited_sha256", "own", F.struct(join("hashes"), join("places")).alias("edited"), "_following")
    return got.select(
        key, "n_chars", "edited_sha256", "own", "edited",
        likeness(F.col("own.hashes"), F.col("edited.hashes")).alias("near_edited"), likeness(F.col("own.hashes"), F.col("_following")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: fingerprints of every document and of its edited text, and their likeness."""
    got = fingerprints(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"), "near_edited", "near_next")
