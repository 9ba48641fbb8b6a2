"""Clusters of images by perceptual hash: equal hashes, and near ones by bands."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.hashes import bands, hamming, short_hex


def exact_hash_dups(images: DataFrame) -> DataFrame:
    """(hash, gno) of images whose hash others have too."""
    rows = images.select(short_hex(F.col("IMG_HASH_V2")).alias("hash"), F.col("G_NO").alias("gno")).where("hash IS NOT NULL")
    shared = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("hash")
    return rows.join(shared, "hash", "left_semi")


def band_rows(images: DataFrame, settings: Settings) -> DataFrame:
    """(band, hash, gno): a row for each band of each image, repeats included."""
    rows = images.select(short_hex(F.col("IMG_HASH_V2")).alias("hash"), F.col("G_NO").alias("gno")).where("hash IS NOT NULL")
    return rows.select(F.explode(bands(F.col("hash"), settings.hash_bits, settings.band_bits)).alias("band"), "hash", "gno")


def band_candidates(images: DataFrame, settings: Settings) -> DataFrame:
    """Rows of bands that hold two rows or more."""
    rows = band_rows(images, settings)
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("band")
    return rows.join(shared, "band", "left_semi")


def hamming_pairs(images: DataFrame, settings: Settings) -> DataFrame:
    """(band, hash, before, distance): each hash of a band and the one before it in
    order, where they differ in fewer bits than the threshold."""
    hashes = band_rows(images, settings).select("band", "hash").distinct()
    before = hashes.withColumn("before", F.lag("hash").over(Window.partitionBy("band").orderBy("hash")))
    near = before.withColumn("distance", hamming(F.col("hash"), F.col("before"), max(64, settings.hash_bits)).cast("bigint"))
    return near.where(F.col("distance") < settings.threshold)


def image_clusters(images: DataFrame, settings: Settings) -> DataFrame:
    """(gno, leader): within a band, hashes in order follow a leader as long as
    they are nearer to it than the threshold; the next one leads anew. Images of a
    leader with two rows or more make a cluster. An image may be in several.

    The scan depends on the hashes alone, so rows of a band first become hashes
    with counts: a band that blank images fill is one row. A partition is then
    read in order, with one leader in memory, whatever a band's size.
    """
    if settings.threshold <= 0:
        return images.select(F.col("G_NO").alias("gno"), F.col("IMG_HASH_V2").alias("leader")).where(F.lit(False))
    rows = band_rows(images, settings)
    threshold = settings.threshold

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        band = leader = None
        value = 0
        for frame in frames:
            leaders = []
            for b, h in zip(frame["band"], frame["hash"], strict=True):
                own = int(h, 16)
                if b != band or (own ^ value).bit_count() >= threshold:
                    band, leader, value = b, h, own
                leaders.append(leader)
            yield frame.assign(leader=leaders)

    hashes = rows.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n"))
    led = hashes.repartition("band").sortWithinPartitions("band", "hash").mapInPandas(scan, "band string, hash string, n bigint, leader string")
    large = led.groupBy("band", "leader").agg(F.sum("n").alias("n")).where("n >= 2").select("band", "leader")
    labels = led.join(large, ["band", "leader"], "left_semi").select("hash", "leader").distinct()
    own = images.select(short_hex(F.col("IMG_HASH_V2")).alias("hash"), F.col("G_NO").alias("gno"))
    return own.join(labels, "hash").select("gno", "leader").distinct()


def image_clusters_sorted(images: DataFrame, settings: Settings) -> DataFrame:
    """(leader, gno), in that order."""
    return image_clusters(images, settings).select("leader", "gno").orderBy("leader", "gno")
