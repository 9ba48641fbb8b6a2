"""Substring dedup by hashing lines and the sentences in them.

A text is cut into units at line ends and, inside a line, after sentence ends,
so that a passage is found wherever it stands in a line. Units are normalised
(lower case, single spaces), hashed to 128 bits and grouped over all documents.
The occurrence in the document with the least id is kept, at its first place;
the others are repeats. Repeats go where they make up a run of at least
``min_words`` words in one document: a lone short sentence that many documents
share by chance stays. What goes is reported as offsets into the original text.

Texts are hashed once; their digests are kept in the shared folder and read for
the groups and for the join back. Digests are grouped with partial aggregation. The
join's one side has a row for each digest that several documents have, its other
side the digests of all units: a hot digest is one row on the first, so adaptive
execution can split the second. No group of occurrences is ever collected, and text
moves only once, to meet the unit numbers that its document loses.

Defined results
    null text            stays null, without removed spans
    empty text           stays empty
    ties                 rows of one id are one document: none is a repeat of another
    texts of one id      each loses its own repeats, as unit numbers hold for one text
    null ids             rank after all others, and are one document like rows of one id
    all units removed    the empty text
    empty table          no rows
Other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, materialize, named, quoted, schema_of, text_hashes

#: A run of repeated units goes if it has so many words.
MIN_WORDS = 8
#: Scripts without spaces, of which each character counts as a word.
WIDE = re.compile(r"[぀-ヿ㐀-䶿一-鿿]")
#: Where a unit ends: a line feed, or the end of a sentence.
BREAK = re.compile(r"[\n.!?。！？](?:(?<=[\n。！？])|(?=\s))")


def units(text: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised form) of every unit that isn't blank."""
    found = []
    at = 0
    for stop in [*(m.end() for m in BREAK.finditer(text)), len(text)]:
        part = text[at:stop]
        words = part.lower().split()
        if words:
            found.append((stop - len(part.lstrip()), at + len(part.rstrip()), " ".join(words)))
        at = stop
    return found


def word_count(form: str) -> int:
    """Words parted by white space; ideographs and kana singly."""
    return form.count(" ") + 1 if form.isascii() else len(WIDE.sub(" x ", form).split())


def unit_digests(text: str) -> np.ndarray:
    """(units, 2) numbers of 64 bits."""
    data = b"".join(hashlib.blake2b(form.encode("utf-8", "replace"), digest_size=16).digest() for _, _, form in units(text))
    return np.frombuffer(data, "<i8").reshape(-1, 2)


def repeated_spans(text: str, repeats: set[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Offsets of what goes: runs of units whose numbers are in ``repeats`` or that
    stood in this text before."""
    spans: list[tuple[int, int]] = []
    seen: set[str] = set()
    start = end = -1
    words = 0

    def close() -> None:
        if words >= min_words:
            spans.append((start, end))

    for i, (a, b, form) in enumerate(units(text)):
        if i in repeats or form in seen:
            if words == 0:
                start = a
            end = b
            words += word_count(form)
        else:
            close()
            words = 0
        seen.add(form)
    close()
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The rest of ``text``; white space around a removed span shrinks to one
    character, a line feed where there was one."""
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    out = parts[0]
    for part in parts[1:]:
        head, tail = out.rstrip(), part.lstrip()
        gap = out[len(head) :] + part[: len(part) - len(tail)]
        out = head + ("\n" if "\n" in gap else " " if gap else "") * bool(head and tail) + tail
    return out


DIGESTS = "k {kind}, x bigint, y bigint, units array<struct<n: int, a: bigint, b: bigint>>"


def digest_lists(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, x, y, units): for each text its id, its hashes, and number and digest of
    each unit that it didn't have before."""
    kind = df.schema[key].dataType.simpleString()
    names = ["k", "x", "y", "units"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                batch = big.slice(at, 500)
                sizes, number, digest = [0], [], []
                for value in batch.column(3).to_pylist():
                    pairs = unit_digests(value or "")
                    # within a text only the first of equal units counts
                    _, first = np.unique(pairs.view("<i8,<i8"), return_index=True)
                    sizes.append(len(first))
                    number.append(first)
                    digest.append(pairs[first])
                digests = np.concatenate(digest)
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate(number).astype(np.int32)), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())], names=["n", "a", "b"])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(np.cumsum(sizes).astype(np.int32), flat)], names=names)

    x, y = text_hashes(named(text))
    return df.select(named(key).alias("k"), x.alias("x"), y.alias("y"), named(text).alias("t")).mapInArrow(run, DIGESTS.format(kind=kind))


def find_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x, y, repeats): for each text of a document, known by its hashes x and
    y, the numbers of units that an earlier document has; texts without any have no
    row."""
    lists = materialize(digest_lists(df, key, text), "unit-digests")
    # min leaves out nulls: only where all ids are null is there no first document
    groups = lists.select("k", F.inline("units")).groupBy("a", "b").agg(F.min("k").alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    later = lists.select("k", "x", "y", F.inline("units")).join(groups, ["a", "b"]).where(~F.col("k").eqNullSafe(F.col("head")))
    return later.groupBy("k", "x", "y").agg(F.collect_set("n").alias("repeats")).withColumnRenamed("k", key)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, spans: str = "removed") -> DataFrame:
    """``df`` with repeats removed from ``text`` and a column ``spans`` of (start,
    end) in the original text, counted in code points."""
    own = [free_name(df, f"dedup_{c}") for c in ("key", "x", "y", "repeats")]
    repeats = find_repeats(df, key, text).toDF(*own)
    x, y = text_hashes(named(text))
    same = named(key).eqNullSafe(F.col(own[0])) & (x == F.col(own[1])) & (y == F.col(own[2]))
    names = [c for c in df.columns if c != spans]
    joined = df.select(*map(named, names)).join(repeats, same, "left")
    at, last = names.index(text), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for begin in range(0, big.num_rows, 500):
                batch = big.slice(begin, 500)
                texts, gone = [], []
                for value, marked in zip(batch.column(at).to_pylist(), batch.column(last).to_pylist(), strict=True):
                    cut = repeated_spans(value, set(marked or ()), min_words) if value else []
                    texts.append(without(value, cut) if cut else value)
                    gone.append([{"start": a, "end": b} for a, b in cut])
                columns = list(batch.columns[:last])
                columns[at] = pa.array(texts, pa.string())
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, kind)], names=[*names, spans])

    schema = schema_of(df, names, f"{quoted(spans)} array<struct<start: int, end: int>>")
    return map_arrow(joined.select(*map(named, names), F.col(own[3])), run, schema)
