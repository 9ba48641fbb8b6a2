"""Document fingerprints by winnowing, with DataFrame functions only.

A text's units are its words; letters of scripts that are written without
spaces are units of their own, and longer words are cut into units of
:data:`LONGEST` code points. Every k consecutive units have a rolling hash; from
each window of w consecutive hashes the least is chosen, the rightmost of equal
ones, and kept with its position. Two texts that share k + w - 1 consecutive
units share a fingerprint, and no match shorter than k units can cause one.

A gram's hash is a polynomial in its units' CRC-32 modulo :data:`PRIME`. Hash and
position are packed into one number, hash above and position, counted down,
below: the least packed number of a window is then the least hash, rightmost of
ties.

Defined results
    null or empty text         no fingerprint; two such texts are alike (1.0), one
                               such text is unlike any other (0.0)
    fewer than k units         one hash over all of them
    fewer than w hashes        the least of them
    repeated rows              equal fingerprints; neighbours in order of id, then text
    null ids                   first in the order
    ids                        whole numbers, or text that holds them; others fail the job
    a single row               its own neighbour
    empty table                no rows
Only the columns named are read, so other columns may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Units of a gram, and grams of a window.
K, W = 3, 4
#: Code points of a unit, at most.
LONGEST = 16
#: White space, and scripts that are written without it: Thai, Lao, Tibetan, Myanmar, Khmer, kana, ideographs.
WHITE, WIDE = "\\x09-\\x0D\\x20", "\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
UNIT = f"[{WIDE}]|[^{WHITE}{WIDE}]{{1,{LONGEST}}}"
#: Of the hash: below 2**33, and a base below 2**29, so that no step passes 63 bits.
PRIME, BASE = (1 << 33) - 9, 411_770_977
#: Bits of a packed number that hold the position: more units than a string can have.
POSITION_BITS = 30
_POSITIONS = (1 << POSITION_BITS) - 1
#: Texts go to ranges of the key of about so many rows.
ROWS_PER_RANGE = 4_000
#: Ranges at most: their bounds are constants of the plan. Beyond so many times ROWS_PER_RANGE rows, ranges grow.
MAX_RANGES = 100_000


def units(text: Column) -> Column:
    """Words of at most LONGEST code points; letters of scripts without spaces singly."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _pack(h: Column, position: Column) -> Column:
    return F.shiftleft(h, POSITION_BITS).bitwiseOR(F.lit(_POSITIONS).cast("long") - position.cast("long"))


def _roll(so_far: Column, unit: Column) -> Column:
    return (so_far * F.lit(BASE).cast("long") + unit) % F.lit(PRIME)


def winnow(text: Column, k: int = K, w: int = W) -> Column:
    """Chosen packed numbers, in order of position."""

    def grams(h: Column) -> Column:
        starts = F.slice(h, F.lit(1), F.size(h) - (k - 1))
        whole = F.array(_pack(F.aggregate(h, F.lit(0).cast("long"), _roll), F.lit(0)))
        each = F.transform(starts, lambda x, i: _pack(reduce(_roll, (h[i + j] for j in range(1, k)), x), i))
        return F.when(F.size(h) == 0, F.slice(h, 1, 0)).when(F.size(h) < k, whole).otherwise(each)

    def choose(g: Column) -> Column:
        starts = F.slice(g, F.lit(1), F.size(g) - (w - 1))
        least = F.transform(starts, lambda x, i: F.least(x, *(g[i + j] for j in range(1, w))) if w > 1 else x)
        return F.when(F.size(g) == 0, g).when(F.size(g) < w, F.array(F.array_min(g))).otherwise(F.array_distinct(least))

    hashed = F.transform(units(text), lambda u: F.crc32(u.cast("binary")))
    return _bind(hashed, lambda h: _bind(grams(h), choose))


def hash_set(packed: Column) -> Column:
    """Distinct hashes of packed numbers."""
    return F.array_distinct(F.transform(packed, lambda x: F.shiftright(x, POSITION_BITS)))


def positions(packed: Column) -> Column:
    return F.transform(packed, lambda x: F.lit(_POSITIONS) - x.bitwiseAND(F.lit(_POSITIONS)))


def digest(packed: Column) -> Column:
    """A short text that is equal for equal fingerprints, positions included."""
    return F.sha2(F.concat_ws(",", F.transform(packed, lambda x: x.cast("string"))), 256)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def fingerprints(df: DataFrame, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``df`` with ``fingerprint``: an array of (hash, position)."""
    made = df.withColumn("__packed", winnow(F.col(text), k, w))
    both = F.transform("__packed", lambda x: F.struct(F.shiftright(x, POSITION_BITS).alias("hash"), (F.lit(_POSITIONS) - x.bitwiseAND(F.lit(_POSITIONS))).cast("int").alias("position")))
    return made.withColumn("fingerprint", both).drop("__packed")


# ---------------------------------------------------------------- neighbours


def range_of(k: Column, cuts: list[int]) -> Column:
    """How many of the rising ``cuts`` aren't above ``k``: first among every n-th of
    them, then among the n that follow. Null for null."""
    if not cuts:
        return F.when(k.isNotNull(), F.lit(0))
    step = max(1, round(len(cuts) ** 0.5))

    def constant(numbers: list[int]) -> Column:
        # one folded literal, whatever the length
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>") if numbers else F.lit(None).cast("array<bigint>")

    def count(numbers: Column) -> Column:
        return F.coalesce(F.size(F.filter(numbers, lambda c: c <= k)), F.lit(0))

    coarse = cuts[step - 1 :: step]
    whole = _bind(count(constant(coarse)) * step if coarse else F.lit(0), lambda n: n + count(F.slice(constant(cuts), n + 1, F.lit(step))))
    return F.when(k.isNotNull(), whole)


def with_successor(df: DataFrame, key: str = "doc_id", text: str = "text", fingerprint: bool = False) -> DataFrame:
    """(key, text, next): each row's text and that of the next row in order of
    key, then text; after the last row comes the first. With ``fingerprint`` also
    ``own`` and ``next_own``, the packed numbers of both, each text winnowed once.

    Keys are cut into ranges at their quantiles. A range is one window; the first
    row of each range is copied to the end of the range before it, which is one
    row a range, so no task and no window sees all rows.
    """
    rows = df.select(F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    n = rows.select(F.count(F.lit(1)).alias("n")).first()["n"]
    ranges = max(1, min(MAX_RANGES, n // ROWS_PER_RANGE))
    cuts: list[int] = []
    if ranges > 1:
        cuts = sorted(set(rows.select(F.percentile_approx("k", [i / ranges for i in range(1, ranges)], max(100_000, 10 * ranges))).first()[0] or []))
    # nulls come first: they are in range 0, below every key
    lowest = F.lit(-(1 << 63)).cast("bigint")
    ranged = rows.select(F.coalesce(range_of(F.col("k"), cuts), F.lit(0)).alias("r"), "k", F.coalesce("k", lowest).alias("o"), "t")
    firsts = ranged.groupBy("r").agg(F.min("o").alias("o"))
    before = F.lag("r").over(Window.partitionBy(F.lit(1)).orderBy("r"))
    last = F.max("r").over(Window.partitionBy(F.lit(1)))
    # one row for each range, MAX_RANGES at most; the first range's head follows the last range
    firsts = firsts.select("r", "o", F.coalesce(before, last).alias("to"))
    tails = ranged.join(F.broadcast(firsts), ["r", "o"]).groupBy("to").agg(F.min("t").alias("t"))
    tails = tails.select(F.col("to").alias("r"), F.lit(True).alias("tail"), F.lit(None).cast("bigint").alias("k"), "t")
    every = ranged.select("r", F.lit(False).alias("tail"), "k", "t").unionByName(tails).repartition(ranges, "r")
    order = Window.partitionBy("r").orderBy("tail", F.col("k").asc_nulls_first(), "t")
    if fingerprint:
        every = every.withColumn("own", winnow(F.col("t")))
    following = {"next": F.lead("t").over(order)} | ({"next_own": F.lead("own").over(order)} if fingerprint else {})
    paired = every.withColumns(following).where(~F.col("tail"))
    return paired.select(F.col("k").alias(key), F.col("t").alias(text), "next", *(("own", "next_own") if fingerprint else ()))


def edited_text(text: Column, following: Column) -> Column:
    """``text`` whose last quarter of code points gives way to the first as many
    of ``following``, or all of them."""
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))
