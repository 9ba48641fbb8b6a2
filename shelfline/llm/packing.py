"""Best-fit packing of tokenised documents into sequences of bounded length.

The plan is made over a histogram of piece lengths, never over documents: at
most ``limit`` counts come to the driver, best-fit in falling length runs over
them, and gives intervals of ranks. A document then takes its slot by its rank
within its length. A piece of ``limit`` tokens fills a sequence of its own, so it
needs no rank and is never sorted.

Defined results
    null or empty text  one piece that holds the end token alone
    longer than limit   cut into pieces of ``limit`` tokens; the first piece may
                        be shorter, all others are full
    repeated rows       each row is packed by itself; rows equal in all columns
                        take neighbouring slots in any order
    ties in a length    ranked by a hash bucket, then key, piece and digest
    empty table         no rows
Only the columns named are read, so other columns may have any names.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import materialize, named

LIMIT = 1024
END_ID = 2
#: Words whose ids a worker keeps; when it is reached the cache starts anew.
CACHE_WORDS = 500_000
#: Rows of one length that are ranked together, about: the rows of a length are dealt to as many buckets as that takes.
RANK_ROWS = 100_000


# ---------------------------------------------------------------- tokenising


class WordTokens:
    """Ids of whole texts as packed 32-bit words, by way of a cache of words.

    A pre-token of the byte-level pattern never goes on past a single space or
    line feed that stands between two other characters, so a text may be encoded
    word by word (each with the space before it) where all of its white space is
    of that kind. Texts with other white space, or with a special token's string,
    go to the tokenizer whole. Words that are new go to tiktoken's engine in one
    string; its ranks come from the tokenizer file itself, whose ids are ranks.
    """

    #: White space other than space and line feed.
    ODD = re.compile(r"[^\S \n]")

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        #: The byte-level alphabet: printable bytes stand for themselves, others are numbered from 256.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        alphabet = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.engine = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.line_feed = self.engine.encode_ordinary("\n")[0]
        self.heads: dict[str, bytes] = {}
        self.cache: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def fill(self, cache: dict[str, bytes], words: set[str], before: str) -> None:
        new = list(words.difference(cache))
        if not new:
            return
        ids = np.array(self.engine.encode_ordinary(before + f"\n{before}".join(new)), "<u4")
        ends = [*np.flatnonzero(ids == self.line_feed).tolist(), len(ids)]
        data, at = ids.tobytes(), 0
        for word, end in zip(new, ends, strict=True):
            cache[word] = data[4 * at : 4 * end]
            at = end + 1

    def lines(self, text: str) -> list[list[str]] | None:
        """Words of each line; None where white space isn't single, or is odd."""
        if self.ODD.search(text) or any(x in text for x in self.special):
            return None
        found = [x.split(" ") for x in text.split("\n")]
        return None if any("" in x for x in found) else found

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [self.lines(x) for x in texts]
        if len(self.cache) + len(self.heads) > CACHE_WORDS:
            self.heads, self.cache = {}, {}
        words: set[str] = set()
        heads: set[str] = set()
        for lines in cut:
            for line in lines or ():
                heads.add(line[0])
                words.update(line[1:])
        self.fill(self.cache, words, " ")
        self.fill(self.heads, heads, "")
        odd = [i for i, lines in enumerate(cut) if lines is None]
        rest = dict(zip(odd, self.whole([texts[i] for i in odd]), strict=True))
        feed = np.array([self.line_feed], "<u4").tobytes()
        head, get = self.heads, self.cache.__getitem__
        return [rest[i] if lines is None else feed.join([head[x[0]] + b"".join(map(get, x[1:])) for x in lines]) for i, lines in enumerate(cut)]


def _tokens(path: str) -> WordTokens:
    """One tokenizer a worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


_LOADED: dict[str, WordTokens] = {}


def token_pieces(
    df: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """A row for each piece: key, piece, start, length, ids_crc32 and, if asked
    for, ids. No shuffle."""
    kind = df.schema[key].dataType
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokens(tokenizer_path)
        for big in batches:
            for at in range(0, big.num_rows, 200):
                batch = big.slice(at, 200)
                rows: list[tuple] = []
                data: list[bytes] = []
                for i, ids in enumerate(encode([x or "" for x in batch.column(1).to_pylist()])):
                    ids += end
                    n = len(ids) // 4
                    start, stop = 0, n % limit or min(n, limit)
                    piece = 0
                    while start < n:
                        part = ids[4 * start : 4 * stop]
                        rows.append((i, piece, start, stop - start, zlib.crc32(part)))
                        if with_ids:
                            data.append(part)
                        start, stop, piece = stop, stop + limit, piece + 1
                if not rows:
                    continue
                row, piece, start, length, crc = zip(*rows, strict=True)
                columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    flat = np.frombuffer(b"".join(data), "<u4").astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(np.cumsum([0, *length]).astype(np.int32), flat))
                yield pa.RecordBatch.from_arrays(columns, names=["key", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = f"key {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return df.select(named(key).alias("key"), named(text).alias("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------- planning


def plan_slots(counts: dict[int, int], limit: int = LIMIT) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit in falling length over counts.

    Returns slots (length, first rank, number of ranks, first sequence, offset)
    and how many sequences there are: rank r of a length, r in a slot's ranks,
    goes to sequence ``first sequence + r - first rank`` at ``offset``. Bins that
    are alike stay one group (first sequence, how many); a group splits only
    where a length runs out, so the work depends on ``limit`` alone.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> groups of bins
    rooms: list[int] = []  # its keys in order
    sequences = 0

    def put_back(left: int, group: tuple[int, int]) -> None:
        if left not in room:
            room[left] = []
            bisect.insort(rooms, left)
        room[left].append(group)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= limit:
            raise ValueError("lengths must be from 1 to the limit")
        todo, rank = counts[length], 0
        while todo:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):  # new bins, as many as this length fills
                put_back(limit, (sequences, -(-todo // (limit // length))))
                sequences += -(-todo // (limit // length))
                continue
            left = rooms[at]
            first, bins = room[left].pop()
            if not room[left]:
                del room[left], rooms[at]
            each = left // length  # the tightest bin stays the tightest until it is full
            full = min(bins, todo // each)
            for k in range(each if full else 0):
                slots.append((length, rank, full, first, limit - left + k * length))
                rank += full
            todo -= full * each
            if full:
                put_back(left - each * length, (first, full))
            if full < bins and todo:
                # fewer than one bin's worth remain: they open one more bin
                for k in range(todo):
                    slots.append((length, rank + k, 1, first + full, limit - left + k * length))
                put_back(left - todo * length, (first + full, 1))
                full, todo = full + 1, 0
            if full < bins:
                put_back(left, (first + full, bins - full))
    return slots, sequences


# ---------------------------------------------------------------- packing


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (key, piece, length, ...).

    Full pieces take sequences of their own, with negative numbers. Of the others
    ranks come from two levels: rows of one length are dealt to hash buckets, ranked
    inside each bucket, and shifted by the counts of the buckets before. A length has
    as many buckets as its count asks for, so one that a third of all pieces have is
    sorted by many tasks, at every size.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    full = pieces.where(F.col("length") == limit).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")})
    rest = pieces.where(F.col("length") != limit)
    totals = {r["length"]: r["count"] for r in rest.groupBy("length").count().collect()}  # fewer than limit rows
    shares = [1] * (limit + 1)
    for length, n in totals.items():
        shares[length] = -(-n // RANK_ROWS)
    # one folded literal: buckets of each length
    buckets = F.split(F.lit(",".join(map(str, shares))), ",").cast("array<int>")
    rest = rest.withColumn("__bucket", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.get(buckets, F.col("length").cast("int"))).cast("int"))
    shift: dict[tuple[int, int], int] = {}
    if max(shares) > 1:
        at = dict.fromkeys(totals, 0)
        counted = rest.groupBy("length", "__bucket").count().collect()  # limit rows, and one more for every RANK_ROWS pieces
        for length, bucket, n in sorted((r["length"], r["__bucket"], r["count"]) for r in counted):
            shift[length, bucket] = at[length]
            at[length] += n
    slots, _ = plan_slots(totals, limit)
    slots.sort()
    first = np.cumsum([0, *shares])  # a length's buckets stand side by side
    shifts = np.zeros(first[-1], dtype=np.int64)
    for (length, bucket), n in shift.items():
        shifts[first[length] + bucket] = n
    table = np.array(slots, dtype=np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast((first, shifts, table))  # bounded by the limit, but for one number for every RANK_ROWS pieces
    within = Window.partitionBy("length", "__bucket").orderBy("key", "piece", "ids_crc32")
    ranked = rest.withColumn("__rank", F.row_number().over(within).cast("bigint") - 1)
    at = {c: i for i, c in enumerate(ranked.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, shifts, table = plan.value
        scale = int(table[:, 1].max()) + 2 if len(table) else 2
        begins = table[:, 0] * scale + table[:, 1]
        for batch in batches:
            length, bucket, rank = (batch.column(at[c]).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "__bucket", "__rank"))
            rank = rank + shifts[first[length] + bucket]
            slot = table[np.searchsorted(begins, length * scale + np.minimum(rank, scale - 1), side="right") - 1]
            columns = [batch.column(at[c]) for c in names] + [pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(run, schema).unionByName(full)


def pack_documents(df: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """Tokenises once, keeps the pieces' lengths and digests in the shared folder,
    plans and packs: key column under its own name, piece, start, length,
    ids_crc32, sequence_id, offset."""
    pieces = materialize(token_pieces(df, tokenizer_path, text, key, limit, end_id), "pieces")
    return pack(pieces, limit).withColumnRenamed("key", key)
