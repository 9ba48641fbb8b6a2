"""Named queries over the driver tables, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NULL_TEXT, Settings
from ..functions.text import millis
from ..operators import clustering, counts, delta, eligibility, imagehash, refine
from ..sources import text_files
from . import fixtures
from .oracle import ORACLES

__all__ = ["ORACLES", "QUERIES"]

IMAGE_SETTINGS = Settings(hash_bits=64, band_bits=16)
FINE_SETTINGS = Settings(hash_bits=64, band_bits=8)


def _goods_columns(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("G_NO", "CTRL_ROWID", "G_NAME", "RANK", millis(F.col("G_POST_TIME")).alias("POST_MS"), *more)


def scan_tsv_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_files.rows_of_lines(fixtures.tsv_lines(spark, sf_dir), ("ORDER_NO", "STATUS", "PRIORITY", "SELLER"))


def json_scan_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("value"))
    return text_files.fields_of_json(rows, ("k",), keep=("event_id",))


def active_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.active_ads(fixtures.ads(spark, sf_dir))


def eligible_listing_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.eligible_listings(fixtures.goods(spark, sf_dir)).select("G_NO", "CTRL_ROWID", "G_NAME", "G_PRIORITY_ORDER", "G_CLOSE_DATE", "IS_DELETE")


def seller_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligibility.excluded_sellers(fixtures.sellers(spark, sf_dir))


def seller_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = eligibility.excluded_sellers(fixtures.sellers(spark, sf_dir))
    return eligibility.without_sellers(fixtures.goods(spark, sf_dir), out).select("G_NO", "CTRL_ROWID", "G_NAME")


def eligible_goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.eligible(spark, sf_dir).withColumns({c: F.coalesce(c, F.lit(NULL_TEXT)) for c in ("RANK", "G_CLASS", "G_LASTUPDATE")})
    return _goods_columns(rows, "G_CLASS", "G_LASTUPDATE", "G_DIRECT_PRICE")


def fingerprint_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _goods_columns(clustering.fingerprinted(fixtures.eligible(spark, sf_dir)), "FINGERPRINT")


def cluster_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_info(clustering.fingerprinted(fixtures.eligible(spark, sf_dir)))


def seller_dup_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.seller_dup_ratio(clustering.fingerprinted(fixtures.eligible(spark, sf_dir)))


def fingerprint_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.fingerprint_runs(clustering.fingerprinted(fixtures.eligible(spark, sf_dir)))


def group_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _goods_columns(fixtures.refined(spark, sf_dir), "GROUP_HEAD", "GROUP_NUM", "FINGERPRINT")


def group_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.group_heads(fixtures.refined(spark, sf_dir)).select("FINGERPRINT", "G_NO", "GROUP_NUM")


def snapshot_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.snapshots(spark, sf_dir)


def snapshot_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.snapshot_top2(fixtures.snapshots(spark, sf_dir)).withColumn("rn", F.col("rn").cast("bigint"))


def group_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.group_delta(fixtures.snapshots(spark, sf_dir))


def index_update_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.index_update_docs(group_delta(spark, sf_dir), Settings().batch_ts)


def exact_hash_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imagehash.exact_hash_dups(fixtures.images(spark, sf_dir))


def image_band_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imagehash.band_candidates(fixtures.images(spark, sf_dir), IMAGE_SETTINGS)


def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imagehash.hamming_pairs(fixtures.images(spark, sf_dir), IMAGE_SETTINGS)


def image_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imagehash.image_clusters(fixtures.images(spark, sf_dir), IMAGE_SETTINGS)


def image_clusters_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imagehash.image_clusters(fixtures.images(spark, sf_dir), FINE_SETTINGS)


def image_clusters_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imagehash.image_clusters_sorted(fixtures.images(spark, sf_dir), IMAGE_SETTINGS)


def count_by_first_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_by_first_col(fixtures.lines(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        scan_tsv_arity, json_scan_props, active_ads, eligible_listing_filter, seller_exclusion, seller_anti_join, eligible_goods, fingerprint_result,
        cluster_info, seller_dup_ratio, fingerprint_runs, group_refine, group_heads, snapshot_union, snapshot_top2, group_delta, index_update_docs,
        exact_hash_dups, image_band_candidates, hamming_pairs, image_clusters, image_clusters_fine, image_clusters_sorted, count_by_first_col,
    )
}
