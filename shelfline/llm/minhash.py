"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct 5-word shingles. 128 minima of the set give
32 band keys for candidates; of each minimum the lowest two bits are kept, packed
into four numbers, and the share of equal bit pairs, corrected for chance
collisions, estimates the similarity. Candidates far below the threshold drop
out; the rest are confirmed on the full sets, so no link is wrong.

Groups of copies. Documents of equal sets are one class, held by its least id.
Only classes have bands, links and components. In each bucket of a band every
class is compared with the bucket's least class, its hub: as many pairs as
members. Where a bucket's members are then in several components, those outside its
largest component, the strays, are compared with all of the bucket, block by block,
inside a task: first by the packed signatures alone, which tell who has a likely
partner in another component; only those come again, with their full sets, and a
block hands on one link for each component that a stray reaches. So every pair of
one bucket is confirmed, refused, or already in one component, while no group is
expanded into its pairs and no set moves without a likely partner.

A pair of similarity 0.75 shares no bucket with a chance of 5 in a million.

Defined results
    null or empty text, or white space alone   an empty set, linked with nothing
    fewer than 5 words    the whole sequence is the one shingle
    repeated rows         one class
    several texts of one id   one node, which all of them share
    null ids              sets are counted; never linked, component null, kept
    ids                   whole numbers, or text that holds them; others fail the job
    very long words       hashed as a whole
    empty table           no rows
Only the columns named are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, named

SHINGLE = 5
SIMILAR_PERCENT = 75
PERMUTATIONS, BAND_ROWS, BITS = 128, 4, 2
BANDS = PERMUTATIONS // BAND_ROWS
WORDS = PERMUTATIONS * BITS // 64
#: Estimates so many standard deviations below the threshold are refused without the sets.
SIGMAS = 6.0
#: Strays and members of a bucket that meet in one block, about.
BLOCK_STRAYS, BLOCK_MEMBERS = 512, 512
#: The rows of a node with many neighbours are dealt to so many parts; a bucket's pairs with its hub to parts of about so many.
SALTS, HUB_ROWS = 16, 512

_RANDOM = np.random.default_rng(20240501)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = _RANDOM.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time; a text is cut between words. A word of so many bytes is hashed by itself.
_PIECE, _LONG_WORD = 1 << 20, 1 << 12
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = base & 0xFFFFFFFFFFFFFFFF
    return np.multiply.accumulate(out)


_TABLES: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, made on first use."""
    if len(_TABLES[0]) < n:
        size = max(n, _PIECE + 2 * _LONG_WORD)
        _TABLES[:] = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _TABLES


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _whole_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of lower-cased UTF-8 text: a polynomial in the
    bytes, taken from prefix sums, and for long words a digest."""
    out = []
    at = 0
    while at < len(data):
        stop = min(len(data), at + _PIECE)
        if stop < len(data) and not _WHITE[data[stop]]:
            # the word at the end belongs to this piece, or to none if it is long
            cut = _BLANK.search(data, stop, stop + _LONG_WORD)
            if cut:
                stop = cut.start()
            elif stop + _LONG_WORD >= len(data):
                stop = len(data)
            else:
                head = data[at:stop]
                start = at + max((head.rfind(bytes([c])) for c in (0x20, *range(0x09, 0x0E)))) + 1
                if start == at:
                    cut = _BLANK.search(data, stop)
                    stop = cut.start() if cut else len(data)
                    out.append(np.array([_whole_hash(data[at:stop])], dtype=np.uint64))
                    at = stop
                    continue
                stop = start
        raw = np.frombuffer(data, np.uint8, count=stop - at, offset=at)
        power, inverse = _tables(len(raw) + 1)
        word = ~_WHITE[raw]
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        prefix = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * power[: len(raw)], out=prefix[1:])
        found = _mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts >= _LONG_WORD):
            found[i] = _whole_hash(data[at + starts[i] : at + ends[i]])
        out.append(found)
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        whole = (words * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
        return _mix(np.array([whole], dtype=np.uint64))
    sums = words[: n - SHINGLE + 1] * _PLACE[0]
    for i in range(1, SHINGLE):
        sums = sums + words[i : n - SHINGLE + 1 + i] * _PLACE[i]
    return np.unique(_mix(sums))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a set that isn't empty."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        np.minimum(low, (shingles[at : at + 2048, None] * _MULTIPLY).min(axis=0), out=low)
    return _mix(low)  # the low bits of a product follow those of its factor: they are mixed before any is kept


def signature(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed low bits, band keys) of minima."""
    bits = (low & np.uint64((1 << BITS) - 1)).reshape(WORDS, 64 // BITS)
    packed = np.bitwise_or.reduce(bits << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=1)
    rows = low.reshape(BANDS, BAND_ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        key = _mix(key * np.uint64(_BASE) + rows[:, i])
    return packed, key


def estimated(a: str, b: str) -> Column:
    """Similarity from packed signatures ``a`` and ``b`` (arrays): the share of
    unequal bit pairs by bit counts, corrected for pairs that are equal by chance."""
    if BITS != 2:
        raise ValueError("written for two bits")
    low = F.lit(0x5555555555555555)
    unequal = []
    for i in range(WORDS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        unequal.append(F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low)))
    same = 1 - reduce(lambda p, q: p + q, unequal) / F.lit(float(PERMUTATIONS))
    chance = 0.5**BITS
    return (same - chance) / (1 - chance)


def least_estimate(percent: int = SIMILAR_PERCENT) -> float:
    chance = 0.5**BITS
    same = chance + (1 - chance) * percent / 100
    return percent / 100 - SIGMAS * (same * (1 - same) / PERMUTATIONS) ** 0.5 / (1 - chance)


# ---------------------------------------------------------------- sketches


def sketches(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, a, b, packed, bands): size, 128-bit digest and signature
    of each row's set; the last four null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                batch = big.slice(at, 500)
                rows = []
                for value in batch.column(1).to_pylist():
                    own = shingle_set(value)
                    if not len(own):
                        rows.append((0, None, None, None, None))
                        continue
                    a, b = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), "<i8").tolist()
                    packed, bands = signature(minima(own))
                    rows.append((len(own), a, b, packed.view(np.int64), bands.view(np.int64)))
                n, a, b, packed, bands = zip(*rows, strict=True)
                longs, lists = pa.int64(), pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, longs), pa.array(a, longs), pa.array(b, longs), pa.array(packed, lists), pa.array(bands, lists)],
                    names=["id", "n_shingles", "a", "b", "packed", "bands"],
                )

    rows = df.select(named(key).cast("bigint").alias("id"), named(text).alias("t"))
    return rows.mapInArrow(run, "id bigint, n_shingles bigint, a bigint, b bigint, packed array<bigint>, bands array<bigint>")


def full_sets(df: DataFrame, ids: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, set) of the documents in ``ids``; one row for each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                batch = big.slice(at, 500)
                sets = [shingle_set(x).view(np.int64) for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    rows = df.select(named(key).cast("bigint").alias("id"), named(text).alias("t")).join(ids, "id", "left_semi")
    return rows.mapInArrow(run, "id bigint, set array<bigint>")


# ---------------------------------------------------------------- links


def confirm(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (x, y, parts) that are similar: by estimate first, then on
    sets. A pair of a large bucket goes to one of ``parts`` copies of its y, the hub, so
    that no hub's pairs are a single task's work."""
    dealt = materialize(pairs.withColumn("part", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int")), "pairs")
    hubs = dealt.groupBy("y").agg(F.max("parts").alias("parts"))

    def of_hubs(rows: DataFrame, column: str, name: str) -> DataFrame:
        """(y, part, column) for each part of each hub."""
        copies = rows.select(F.col("id").alias("y"), F.col(column).alias(name)).join(hubs, "y")
        return copies.select("y", name, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    x = reps.select(F.col("id").alias("x"), F.col("packed").alias("px"))
    near = estimated("px", "py") >= least_estimate(percent)
    likely = dealt.join(x, "x").join(of_hubs(reps, "packed", "py"), ["y", "part"]).where(near).select("x", "y", "part").distinct()
    joined = likely.join(sets.select(F.col("id").alias("x"), F.col("set").alias("sx")), "x").join(of_hubs(sets, "set", "sy"), ["y", "part"])
    both = F.size(F.array_intersect("sx", "sy")).cast("bigint")
    similar = 100 * both >= percent * (F.size("sx") + F.size("sy") - both)
    return joined.where(similar).select("x", "y").distinct()


def _likely(strays: pa.Table, members: pa.Table, percent: int) -> np.ndarray:
    """Which strays (rows) and members (columns) of other components have signatures
    alike enough; the same estimate as :func:`estimated`."""
    left, right = (t["packed"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, WORDS) for t in (strays, members))
    unequal = np.zeros((len(left), len(right)), dtype=np.uint16)
    low = np.uint64(0x5555555555555555)
    for i in range(WORDS):
        x = left[:, i, None] ^ right[None, :, i]
        unequal += np.bitwise_count((x | (x >> np.uint64(1))) & low)
    chance = 0.5**BITS
    estimate = ((1 - unequal / PERMUTATIONS) - chance) / (1 - chance)
    return (estimate >= least_estimate(percent)) & (strays["c"].to_numpy()[:, None] != members["c"].to_numpy()[None, :])


def _linked(strays: pa.Table, members: pa.Table, percent: int) -> pa.Table:
    """(x, y): for each stray, a member of each other component that it is similar
    to, by full sets where the signatures are alike."""
    likely = _likely(strays, members, percent)
    lists = members["set"].combine_chunks()
    values = lists.flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    known, place = np.unique(values, return_inverse=True)
    place = place.astype(np.int32)
    ids, parts = members["id"].to_numpy(), members["c"].to_numpy()
    marks = np.zeros(len(known), dtype=np.uint8)
    xs, ys = [], []
    for row, (x, own) in enumerate(zip(strays["id"].to_pylist(), strays["set"], strict=True)):
        if not likely[row].any():
            continue
        own = own.values.to_numpy()
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        at = at[known[at] == own]
        marks[at] = 1
        both = np.add.reduceat(marks[place], starts, dtype=np.int64)
        marks[at] = 0
        hit = np.flatnonzero(likely[row] & (100 * both >= percent * (sizes + len(own) - both)))
        for i in hit[np.unique(parts[hit], return_index=True)[1]]:
            xs.append(x)
            ys.append(int(ids[i]))
    return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})


def _meet(rows: DataFrame, others: DataFrame, columns: tuple[str, ...], run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` over the strays and the members of each block (band, s, m)."""
    keys = ("band", "s", "m")
    renamed = others.select(*[F.col(c).alias(f"o_{c}") for c in (*keys, *columns)]).toDF(*keys, *columns)  # both sides come from one table
    return rows.select(*keys, *columns).groupBy(*keys).cogroup(renamed.groupBy(*keys)).applyInArrow(run, schema)


def stray_links(shared: DataFrame, first: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket (band, hub, id)."""
    known = first.select("id", F.col("component").alias("c"))
    labelled = materialize(shared.select("band", "id").join(known, "id", "left").withColumn("c", F.coalesce("c", "id")), "labelled")
    parts = labelled.groupBy("band", "c").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("band").agg(F.sum("n").alias("all"), F.max(F.struct("n", "c")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    blocks = sizes.select(
        "band", F.col("top.c").alias("main"),
        F.ceil((F.col("all") - F.col("top.n")) / BLOCK_STRAYS).cast("int").alias("sb"), F.ceil(F.col("all") / BLOCK_MEMBERS).cast("int").alias("mb"),
    )
    rows = materialize(labelled.join(blocks, "band").join(reps.select("id", "packed"), "id"), "mixed")
    deal = F.xxhash64("id")
    strays = rows.where("c <> main").withColumn("s", F.pmod(deal, F.col("sb")).cast("int")).withColumn("m", F.explode(F.sequence(F.lit(0), F.col("mb") - 1)))
    others = rows.withColumn("m", F.pmod(deal, F.col("mb")).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.col("sb") - 1)))

    def partners(left: pa.Table, right: pa.Table) -> pa.Table:
        """Those of a block that have a likely partner: a row for each, not for each pair."""
        out = []
        likely = _likely(left, right, percent) if left.num_rows and right.num_rows else np.zeros((left.num_rows, right.num_rows), dtype=bool)
        for table, axis, stray in ((left, 1, True), (right, 0, False)):
            own = table.filter(pa.array(likely.any(axis=axis)))
            out.append(own.append_column("stray", pa.array([stray] * own.num_rows, pa.bool_())))
        return pa.concat_tables(out)

    fields = "band bigint, s int, m int, id bigint, c bigint, packed array<bigint>, stray boolean"
    kept = materialize(_meet(strays, others, ("id", "c", "packed"), partners, fields), "likely")
    whole = kept.join(sets, "id")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64())})
        return _linked(left, right, percent)

    return _meet(whole.where("stray"), whole.where("NOT stray"), ("id", "c", "packed", "set"), run, "x bigint, y bigint")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the ends of ``edges`` (x, y), the component being its
    least id. Large-star and small-star steps in turn, each a partial aggregation
    and a join; neighbours are never collected, and every round is written to the
    shared folder."""

    def tidy(e: DataFrame) -> DataFrame:
        """Edges from the larger to the smaller end."""
        return e.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x <> y").distinct()

    now = materialize(tidy(edges), "edges")
    while True:
        # large star: every larger neighbour of u goes to the least of u and its neighbours
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        # a node's least is handed to each part of its neighbours, so that one with very many is no single task's work
        dealt = both.where("y > x").withColumn("salt", F.pmod(F.xxhash64("y"), F.lit(SALTS)).cast("int"))
        handed = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        large = tidy(dealt.join(handed, ["x", "salt"]).select(F.col("y").alias("x"), F.col("m").alias("y")))
        # small star: u and its smaller neighbours go to the least of them
        small_least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(small_least, "x").select(F.explode(F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e")).select("e.*")
        new = materialize(tidy(small), "edges")
        same = F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))
        if new.agg(F.count(F.lit(1)), same).first() == now.agg(F.count(F.lit(1)), same).first():
            break
        now = new
    return now.select(F.col("x").alias("id"), F.col("y").alias("component")).unionByName(now.select(F.col("y").alias("id"), F.col("y").alias("component"))).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = SIMILAR_PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row."""
    made = materialize(sketches(df, key, text), "sketches")
    usable = made.where("n_shingles > 0 AND id IS NOT NULL")
    classes = usable.groupBy("a", "b").agg(F.min("id").alias("rep"))
    members = materialize(usable.select("id", "a", "b").distinct().join(classes, ["a", "b"]).select("id", "rep", "a", "b"), "members")
    # a class's signature comes from its least id; an id with several texts has several
    reps = materialize(usable.join(members.where("id = rep").select("id", "a", "b"), ["id", "a", "b"], "left_semi").select("id", "packed", "bands"), "reps")
    bucketed = reps.select("id", F.explode("bands").alias("band"))
    size = F.ceil(F.count(F.lit(1)) / HUB_ROWS).cast("int")
    hubs = bucketed.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("other"), size.alias("parts")).where("hub <> other").select("band", "hub", "parts")
    shared = materialize(bucketed.join(hubs, "band").select("band", "hub", "id", "parts"), "buckets")
    sets = materialize(full_sets(df, shared.select("id").distinct(), key, text), "sets")
    stars = shared.where("id <> hub").groupBy(F.col("id").alias("x"), F.col("hub").alias("y")).agg(F.max("parts").alias("parts"))
    first = materialize(components(confirm(stars, reps, sets, percent)), "components")
    more = stray_links(shared, first, reps, sets, percent)
    # an id in several classes joins these classes
    same_id = members.where("id <> rep").select(F.col("id").alias("x"), F.col("rep").alias("y"))
    found = materialize(components(first.select(F.col("id").alias("x"), F.col("component").alias("y")).unionByName(more).unionByName(same_id)), "components")
    rows = made.select(F.col("id").alias(key), "n_shingles").join(found.withColumnRenamed("id", key), key, "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", key)).otherwise(F.col(key))
    return rows.select(key, "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def keep_one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The documents of ``df`` that are their component's least, all columns."""
    own = free_name(df, "near_duplicate")
    plain = df.select(named(key).alias("key"), named(text).alias("text"))
    gone = near_duplicates(plain, "key", "text", percent).where(~F.col("kept")).select(F.col("key").alias(own)).distinct()
    return df.join(gone, named(key).cast("bigint") == F.col(own), "left_anti").select(*map(named, df.columns))
