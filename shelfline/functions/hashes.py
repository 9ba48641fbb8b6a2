"""Fingerprints, perceptual-hash arithmetic and shard routing."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..config import SHARD_BOUNDS
from .text import null_text


def fingerprint(seller: Column, name: Column) -> Column:
    """SHA-1 of seller and title, by which listings group; nulls group too."""
    return F.sha1(F.concat(null_text(seller), F.lit(","), null_text(name)))


def hex_words(h: Column, bits: int = 256) -> Column:
    """A hex hash as an array of 64-bit numbers, highest first."""
    count = -(-bits // 64)
    padded = F.lpad(F.lower(h), count * 16, "0")
    return F.array(*[F.conv(F.substring(padded, 16 * i + 1, 16), 16, -10).cast("bigint") for i in range(count)])


def hamming(a: Column, b: Column, bits: int = 256) -> Column:
    """How many bits of two hex hashes differ; bits above ``bits`` count as well, up
    to the next multiple of 64."""
    x, y = hex_words(a, bits), hex_words(b, bits)
    return reduce(lambda p, q: p + q, [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(-(-bits // 64))])


def short_hex(h: Column) -> Column:
    """Without leading zeros; zero is '0'."""
    return F.regexp_replace(F.lower(h), "^0+(?=.)", "")


def bands(h: Column, hash_bits: int, band_bits: int) -> Column:
    """Every ``band_bits`` bits of a hex hash from the lowest up, as hex without
    leading zeros. A band has no number: equal bits at two places are equal."""
    if band_bits <= 0 or hash_bits <= 0:
        raise ValueError("bands need a positive width")
    count = -(-hash_bits // band_bits)
    if band_bits % 4 == 0:
        digits = band_bits // 4
        padded = F.lpad(F.lower(h), max(count * digits, 64), "0")
        cut = [F.substring(padded, -digits * (i + 1), digits) for i in range(count)]
        return F.array(*[short_hex(c) for c in cut])
    # a band that ends inside a hex digit: over the binary digits
    width = max(count * band_bits, 256)
    nibbles = F.split(F.lpad(F.lower(h), -(-width // 4), "0"), "")
    binary = F.array_join(F.transform(F.filter(nibbles, lambda d: d != ""), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")
    cut = [F.substring(binary, -band_bits * (i + 1), band_bits) for i in range(count)]
    return F.array(*[F.regexp_replace(c, "^0+(?=.)", "") for c in cut])


def murmur3_32(data: bytes, seed: int = 0) -> int:
    """The public 32-bit MurmurHash3, as a signed number."""
    full = 0xFFFFFFFF

    def turn(x: int, r: int) -> int:
        return (x << r | x >> (32 - r)) & full

    def scramble(k: int) -> int:
        return turn(k * 0xCC9E2D51 & full, 15) * 0x1B873593 & full

    h = seed
    whole = len(data) // 4 * 4
    for at in range(0, whole, 4):
        h = (turn(h ^ scramble(int.from_bytes(data[at : at + 4], "little")), 13) * 5 + 0xE6546B64) & full
    if whole < len(data):
        h ^= scramble(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & full
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


@F.pandas_udf(IntegerType())
def murmur3(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else murmur3_32(x.encode())).astype("Int32")


def shard(h: Column) -> Column:
    """Shard of a signed 32-bit hash."""
    found = F.lit(len(SHARD_BOUNDS))
    for i, bound in reversed(list(enumerate(SHARD_BOUNDS))):
        found = F.when(h <= bound, F.lit(i)).otherwise(found)
    return F.when(h.isNotNull(), found)


def sub_shard(h: Column, parts: int = 3) -> Column:
    """One of ``parts`` writers of a hash's shard."""
    return shard(h) + F.pmod(h.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(parts)) * (len(SHARD_BOUNDS) + 1)


def routed(df: DataFrame, key: str, parts: int = 3) -> DataFrame:
    """``df`` with ``SUB_SHARD``, dealt so that each writer's rows are one partition."""
    count = (len(SHARD_BOUNDS) + 1) * parts
    return df.withColumn("SUB_SHARD", sub_shard(murmur3(F.col(key).cast("string")), parts)).repartitionById(count, F.coalesce("SUB_SHARD", F.lit(0)))
