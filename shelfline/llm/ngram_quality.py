"""Quality by an interpolated modified Kneser-Ney model of character 4-grams.

The model is counted over all trusted text. Counts, continuation counts,
context totals and back-off weights are tables sharded by n-gram key; the model
is their join. Documents are scored in blocks: the n-grams of a block are made
distinct, joined with the model's shards, and what comes back is joined with the
block, so that what moves is a block's vocabulary and not its running text, and
no task or driver ever holds the model. The text itself is shuffled once, packed;
each block is a partition of its own. Very long texts are cut where they are counted
and scored, with the symbols before each part as its context.

A fifth of the trusted documents, by a hash of the id, are not counted: they say
how text that the model hasn't seen scores. A document is kept if its perplexity
is at most their quantile in its language (over all languages, where its own has
fewer than :data:`MIN_CALIBRATION`). As the mean of few symbols varies more, the
perplexity compared is the one divided by 1 + :data:`SPREAD` / sqrt(symbols).

Symbols. A character is a symbol of 15 bits: the code points of :data:`OWN`, ideographs
and kana among them, are their own, rarer ones share about 3,000 hashed symbols. A
word that repeats the one before it becomes a mark that says how often it did, as
running text hardly has such words. Four symbols fit one 64-bit key, a shorter n-gram
is the same key with zeros in front: prefixes and suffixes are shifts and masks.

Defined results
    null or empty text, or only white space   no symbols, null perplexity, not kept
    no trusted text          null perplexities, every document with text is kept
    null language            the quantile of all trusted documents
    repeated rows            scored alike; trusted text counts once for each row
    null ids                 never trusted, scored like others
    ids                      whole numbers, or text that holds them; others fail the job
    labels that disagree     trusted if every label that isn't null says so
    empty table              no rows
Other columns pass through drop_low_quality, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, named, text_hashes

ORDER = 4
BITS = 15
BEGIN = (1 << BITS) - 1
#: Code points that are symbols of their own, as [first, end): letters and marks of most scripts, kana, ideographs. Others share the symbols that are left.
OWN = ((0x0000, 0x2100), (0x3000, 0x3100), (0x4E00, 0xA000))
_OWN_SYMBOLS = sum(b - a for a, b in OWN)
#: Characters of text in a block, about, and partitions of blocks, at most: beyond that a task has several blocks, one after the other.
BLOCK_CHARS, MAX_PARTITIONS = 32_000_000, 50_000
#: Characters that a task holds before it packs them, and those taken at a time inside a block.
FLUSH_CHARS, STEP_CHARS = 16_000_000, 2_000_000
#: Share of trusted documents of a language that its threshold keeps, and the slack above it.
QUANTILE, SLACK = 0.995, 1.05
MIN_CALIBRATION, SPREAD = 30, 2.0
#: Buckets of ids by which untrusted documents are left out before the exact join.
ID_BUCKETS = 1 << 20
#: Marks of a word's first to seventh repeat in a row, and of every later one.
REPEATS = "".join(map(chr, range(1, 9)))
_REPEATED = re.compile(r"(?<!\S)(\S++)(?:\s+\1(?!\S))+")


# ---------------------------------------------------------------- symbols and keys


def marked(text: str | None) -> str:
    """Text with runs of white space as one character and repeats as marks."""
    if not text:
        return ""

    def marks(m: re.Match) -> str:
        n = len(m[0].split()) - 1
        return " ".join([m[1], *REPEATS[:n], *REPEATS[-1:] * (n - len(REPEATS))])

    return _REPEATED.sub(marks, text).strip()


def symbols(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if text.isascii():
        return code + 1
    out = _OWN_SYMBOLS + 1 + (code * 2654435761 >> 7) % (BEGIN - 1 - _OWN_SYMBOLS)
    before = 1  # symbol 0 is none's: shorter n-grams have zeros in front
    for first, end in OWN:
        out = np.where((code >= first) & (code < end), code - first + before, out)
        before += end - first
    return out


def keys_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams that end at each position of all texts, and each text's number of them."""
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    pad = chr(0) * (ORDER - 1)  # its symbols are replaced below
    flat = symbols(pad + pad.join(texts)) if texts else np.zeros(0, np.int64)
    ends = np.cumsum(sizes + ORDER - 1)
    starts = ends - sizes - (ORDER - 1)
    own = np.ones(len(flat), dtype=bool)
    for i in range(ORDER - 1):
        own[starts + i] = False
    flat[~own] = BEGIN
    key = flat.copy()
    for i in range(1, ORDER):
        key[i:] |= flat[:-i] << (BITS * i)
    return key[own], sizes


def key_steps(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, numbers of texts, how many keys each has there) of about STEP_CHARS
    characters at a time. A longer text is cut; each part but the first has the
    symbols before it as context."""

    def together(at: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, sizes = keys_of([texts[i] for i in at])
        return keys, np.array(at, dtype=np.int64), sizes

    held: list[int] = []
    size = 0
    for i, x in enumerate(texts):
        if len(x) > STEP_CHARS:
            for start in range(0, len(x), STEP_CHARS):
                lead = min(start, ORDER - 1)
                keys = keys_of([x[start - lead : start + STEP_CHARS]])[0][lead:]
                yield keys, np.array([i]), np.array([len(keys)])
            continue
        held.append(i)
        size += len(x)
        if size >= STEP_CHARS:
            yield together(held)
            held, size = [], 0
    if held:
        yield together(held)


class KeyTable:
    """Where a key stands in an array of distinct keys, by open addressing."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        rest, place = np.arange(len(keys), dtype=np.int32), self._place(keys)
        while len(rest):
            free = self.slots[place] < 0
            self.slots[place[free]] = rest[free]
            left = self.slots[place] != rest
            rest, place = rest[left], (place[left] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions; -1 for keys that aren't there."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int32)
        place = self._place(keys)
        out = self.slots[place]
        rest = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(rest):
            place[rest] = (place[rest] + 1) & self.mask
            out[rest] = self.slots[place[rest]]
            rest = rest[(out[rest] >= 0) & (self.keys[out[rest]] != keys[rest])]
        return out


# ---------------------------------------------------------------- model


def count_ngrams(df: DataFrame, text: str = "text") -> DataFrame:
    """(g, c) of n-grams of the highest order; each task hands on its own sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, pending = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            k, c = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(k)
            k, c = k[order], c[order]
            first = np.flatnonzero(np.diff(k, prepend=-1))
            return k[first], np.add.reduceat(c, first)

        for batch in batches:
            texts = [marked(x) for x in batch.column(0).to_pylist()]
            for own, _, _ in key_steps(texts):
                k, c = np.unique(own, return_counts=True)
                keys.append(k)
                counts.append(c)
                pending += len(k)
                if pending > 2_000_000:
                    k, c = merged()
                    keys, counts, pending = [k], [c], 0
                    if len(k) > 1_000_000:  # too varied to gain by waiting
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["g", "c"])
                        keys, counts = [], []
        if keys:
            k, c = merged()
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["g", "c"])

    return df.select(text).mapInArrow(run, "g bigint, c bigint").groupBy("g").agg(F.sum("c").alias("c"))


def discounts(counted: dict[int, int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more from counts of counts 1 to 4."""
    t1, t2, t3, t4 = (counted.get(i, 0) for i in range(1, 5))
    if not t1 or not t2:
        return 0.5, 0.75, 0.9
    y = t1 / (t1 + 2 * t2)
    d1 = 1 - 2 * y * t2 / t1
    d2 = 2 - 3 * y * t3 / t2
    d3 = 3 - 4 * y * t4 / t3 if t3 else d2
    return tuple(min(max(d, 0.05), k - 0.05) for d, k in ((d1, 1), (d2, 2), (d3, 3)))


def fit_model(trusted: DataFrame, text: str = "text") -> DataFrame:
    """(key, alpha, gamma): an n-gram's own discounted probability and its weight
    as a context of the next order. Key 0 is the empty context."""
    level = count_ngrams(trusted, text)
    level = materialize(level, "ngrams")
    levels = level.select(F.lit(ORDER).alias("n"), "g", "c")
    for n in range(ORDER - 1, 0, -1):
        # a shorter n-gram counts by how many different symbols stand before it
        level = level.groupBy(F.col("g").bitwiseAND(F.lit((1 << (BITS * n)) - 1)).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        levels = levels.unionByName(level.select(F.lit(n).alias("n"), "g", "c"))
    levels = materialize(levels.withColumn("h", F.shiftright("g", BITS)), "levels")
    table: dict[int, dict[int, int]] = {n: {} for n in range(1, ORDER + 1)}
    for row in levels.where("c <= 4").groupBy("n", "c").count().collect():  # four numbers an order
        table[row["n"]][row["c"]] = row["count"]
    d = {n: discounts(x) for n, x in table.items()}

    def by_order(i: int) -> Column:
        return F.element_at(F.array(*[F.lit(d[n][i]) for n in range(1, ORDER + 1)]), F.col("n"))

    contexts = levels.groupBy("n", "h").agg(
        F.sum("c").alias("total"), *(F.sum((F.col("c") == i).cast("bigint")).alias(f"n{i}") for i in (1, 2)), F.sum((F.col("c") > 2).cast("bigint")).alias("n3")
    )
    weights = contexts.select("n", "h", "total", ((by_order(0) * F.col("n1") + by_order(1) * F.col("n2") + by_order(2) * F.col("n3")) / F.col("total")).alias("gamma"))
    off = F.when(F.col("c") == 1, by_order(0)).when(F.col("c") == 2, by_order(1)).otherwise(by_order(2))
    own = levels.join(weights.select("n", "h", "total").hint("merge"), ["n", "h"]).select(F.col("g").alias("key"), (F.greatest(F.col("c") - off, F.lit(0.0)) / F.col("total")).alias("alpha"), F.lit(None).cast("double").alias("gamma"))
    back = weights.select(F.col("h").alias("key"), F.lit(None).cast("double").alias("alpha"), "gamma")
    return materialize(own.unionByName(back).groupBy("key").agg(F.max("alpha").alias("alpha"), F.max("gamma").alias("gamma")), "kn-model")


def log_probabilities(grams: np.ndarray, table: KeyTable, alpha: np.ndarray, gamma: np.ndarray) -> np.ndarray:
    """Natural logs for keys of the highest order, from the smallest order upwards: an n-gram's
    own part plus its context's weight times the next smaller order."""
    p = np.full(len(grams), 1.0 / (1 << BITS))
    for n in range(1, ORDER + 1) if len(alpha) else ():
        gram = grams & ((1 << (BITS * n)) - 1)
        at, context = table.find(gram), table.find(gram >> BITS)
        weight = np.where(context >= 0, gamma[context], 1.0)
        p = np.where(at >= 0, alpha[at], 0.0) + weight * p
    return np.log(p)


# ---------------------------------------------------------------- scoring


class _Held:
    """Rows of a block on their way to a blob; equal texts are held once."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.places: dict[tuple[int, int], int] = {}
        self.rows: list[tuple] = []

    def add(self, text: str | None, key: int | None, hash_x: int, hash_y: int, lang: str | None) -> int:
        """Returns how many characters that adds, about."""
        place = self.places.get((hash_x, hash_y))
        self.rows.append((key, hash_x, hash_y, lang, len(self.texts) if place is None else place))
        if place is not None:
            return 40
        self.places[hash_x, hash_y] = len(self.texts)
        self.texts.append(marked(text))
        return len(self.texts[-1]) + 50

    def packed(self) -> bytes:
        key, hash_x, hash_y, lang, place = zip(*self.rows, strict=True)
        text = pa.DictionaryArray.from_arrays(pa.array(place, pa.int32()), pa.array(self.texts, pa.string()))
        longs = {name: pa.array(own, pa.int64()) for name, own in (("id", key), ("hash_x", hash_x), ("hash_y", hash_y))}
        table = pa.table({**longs, "lang": pa.array(lang, pa.string()), "text": text})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return zstandard.ZstdCompressor(3).compress(sink.getvalue().to_pybytes())


def _unpack(blob: bytes) -> tuple[pa.Table, list[str], np.ndarray]:
    """Rows, distinct texts, and which of them each row has."""
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()
    text = table["text"].combine_chunks()
    text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
    return table, text.dictionary.to_pylist(), text.indices.to_numpy()


def packed_blocks(df: DataFrame, key: str, text: str, lang: str, blocks: int) -> DataFrame:
    """(block, blob): documents marked and packed, a block for each partition. The
    block follows from the text and the partition that a row stands in: equal texts
    of one partition are held once, however many blocks there are, and those of
    different partitions are spread."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Held] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [(b, x.packed()) for b, x in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["block", "blob"])

        for big in batches:
            for at in range(0, big.num_rows, 500):
                for block, x, *others in zip(*(c.to_pylist() for c in big.slice(at, 500).columns), strict=True):
                    size += held.setdefault(block, _Held()).add(x, *others)
                    if size > FLUSH_CHARS:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    hash_x, hash_y = text_hashes(named(text))
    rows = df.select(named(text).alias("text"), named(key).cast("bigint").alias("id"), hash_x, hash_y, named(lang).cast("string").alias("lang"))
    block = F.pmod(F.xxhash64("hash_x", F.spark_partition_id()), F.lit(blocks)).cast("int")
    return deal(rows.select(block.alias("block"), "*").mapInArrow(run, "block int, blob binary"), blocks)


def deal(df: DataFrame, blocks: int) -> DataFrame:
    """Blocks to partitions by their number: one each, up to MAX_PARTITIONS."""
    return df.repartitionById(min(blocks, MAX_PARTITIONS), F.col("block"))


def block_ngrams(blocks: DataFrame) -> DataFrame:
    """(block, key): the distinct n-grams of all orders of each block, contexts
    included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = seen.setdefault(block, [])
                for keys, _, _ in key_steps(_unpack(blob.as_py())[1]):
                    own.append(np.unique(keys))
                    if sum(map(len, own)) > 4_000_000:
                        own[:] = [np.unique(np.concatenate(own))]
        for block, own in seen.items():
            grams = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
            parts = [grams, grams >> BITS]
            for n in range(1, ORDER):
                gram = np.unique(grams & ((1 << (BITS * n)) - 1))
                parts += [gram, gram >> BITS]
            every = np.unique(np.concatenate(parts))
            for at in range(0, len(every), 100_000):
                part = every[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, np.int32)), pa.array(part)], names=["block", "key"])

    return blocks.mapInArrow(run, "block int, key bigint")


#: hash_x and hash_y stand for the text as it was before marking.
SCORED = "id bigint, lang string, hash_x bigint, hash_y bigint, n_symbols bigint, perplexity double"


def score_blocks(blocks: DataFrame, model: DataFrame, count: int) -> DataFrame:
    """Perplexities of the documents in ``count`` packed blocks."""
    # the model grows with the corpus: it is never broadcast, at small sizes neither
    found = block_ngrams(blocks).join(model.hint("merge"), "key").select("block", "key", F.col("alpha").cast("float"), F.col("gamma").cast("float"))
    answers = deal(found, count)
    names = [x.split()[0] for x in SCORED.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = right["key"].to_numpy()
        alpha = np.nan_to_num(right["alpha"].to_numpy().astype(np.float64))
        raw = right["gamma"].to_numpy().astype(np.float64)
        gamma = np.where(np.isnan(raw), 1.0, raw)
        table = KeyTable(np.ascontiguousarray(key))
        out = []
        for blob in left["blob"]:
            docs, texts, place = _unpack(blob.as_py())
            total, n = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
            for grams, numbers, sizes in key_steps(texts):
                different = np.unique(grams)
                value = log_probabilities(different, table, alpha, gamma)[KeyTable(different).find(grams)]
                ends = np.concatenate([[0.0], np.cumsum(value)])
                at = np.concatenate([[0], np.cumsum(sizes)])
                total[numbers] += ends[at[1:]] - ends[at[:-1]]
                n[numbers] += sizes
            total, n = total[place], n[place]
            perplexity = np.exp(-total / np.maximum(n, 1))
            known = (n > 0) & (len(key) > 0)
            out.append(pa.table([docs["id"], docs["lang"], docs["hash_x"], docs["hash_y"], pa.array(n), pa.array(perplexity, mask=~known)], names=names))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], t) for c, t in zip(names, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SCORED)


# ---------------------------------------------------------------- operators


def trusted_ids(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(F.col(key).cast("bigint").alias("id")).agg(F.min(F.col(label).cast("int")).alias("least")).where("least = 1").select("id")


def trusted_text(df: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts of trusted ids. A table of id buckets, of at most ID_BUCKETS rows, is
    broadcast to leave out most other texts before the exact join moves them. The ids
    themselves grow with the corpus, so that join is the same at every size."""

    def bucket(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(ID_BUCKETS)).alias("bucket")

    rows = df.select(named(key).cast("bigint").alias("id"), named(text).alias("text"))
    buckets = trusted.select(bucket("id")).distinct()
    return rows.select("*", bucket("id")).join(F.broadcast(buckets), "bucket", "left_semi").join(trusted.hint("merge"), "id", "left_semi").select("text")


def decisions(df: DataFrame, labels: DataFrame, key: str, text: str, lang: str, quantile: float, slack: float) -> DataFrame:
    """(id, lang, hash_x, hash_y, n_symbols, perplexity, adjusted, threshold, kept)
    for each row."""
    trusted = materialize(trusted_ids(labels, key).withColumn("aside", F.crc32(F.encode(F.col("id").cast("string"), "UTF-8")) % 5 == 1), "trusted")
    model = fit_model(trusted_text(df, trusted.where("NOT aside").select("id"), key, text))
    chars = df.select(F.sum(F.length(named(text))).alias("n")).first()["n"] or 0
    count = max(1, -(-chars // BLOCK_CHARS))
    blocks = packed_blocks(df, key, text, lang, count)
    adjusted = F.col("perplexity") / (1 + SPREAD / F.sqrt(F.greatest("n_symbols", F.lit(1))))
    scored = materialize(score_blocks(blocks, model, count).withColumn("adjusted", adjusted), "scored")
    good = scored.join(trusted.where("aside").select("id"), "id", "left_semi").where(F.col("adjusted").isNotNull())
    cut = (F.percentile_approx("adjusted", quantile, 10_000) * slack).alias("threshold")
    overall = good.agg(cut).first()["threshold"]
    limits = good.where(F.col("lang").isNotNull()).groupBy("lang").agg(cut, F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_CALIBRATION).drop("n")
    joined = scored.join(limits, "lang", "left").withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
    kept = (F.col("n_symbols") > 0) & F.coalesce(F.col("adjusted") <= F.col("threshold"), F.lit(True))
    return joined.select("id", "lang", "hash_x", "hash_y", "n_symbols", "perplexity", "adjusted", "threshold", kept.alias("kept"))


def score_quality(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """(key, lang, n_symbols, perplexity, adjusted, threshold, kept) for each row."""
    made = decisions(df, labels, key, text, lang, quantile, slack)
    return made.select(F.col("id").alias(key), F.col("lang").alias(lang), "n_symbols", "perplexity", "adjusted", "threshold", "kept")


def drop_low_quality(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The kept documents, all columns. Each row goes or stays by its own decision,
    with null ids and with several texts of one id too."""
    made = decisions(df, labels, key, text, lang, QUANTILE, SLACK).where("NOT kept")
    own = [free_name(df, f"quality_{c}") for c in ("id", "lang", "x", "y")]
    gone = made.select("id", "lang", "hash_x", "hash_y").distinct().toDF(*own)
    x, y = text_hashes(named(text))
    same = named(key).cast("bigint").eqNullSafe(F.col(own[0])) & named(lang).cast("string").eqNullSafe(F.col(own[1]))
    return df.join(gone, same & (x == F.col(own[2])) & (y == F.col(own[3])), "left_anti").select(*map(named, df.columns))
