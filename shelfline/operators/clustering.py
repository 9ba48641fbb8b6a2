"""Groups of listings of one seller with one title."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CLUSTERING_COLUMNS, Settings
from ..functions.hashes import fingerprint


def fingerprinted(goods: DataFrame) -> DataFrame:
    return goods.withColumn("FINGERPRINT", fingerprint(F.col("CTRL_ROWID"), F.col("G_NAME")))


def stamped(rows: DataFrame, settings: Settings) -> DataFrame:
    """Fingerprinted listings with the run's time, in the columns of the file between
    jobs; size and head are still unknown."""
    names = {"UPDATE": F.lit(settings.batch_ts)} | {c: F.lit(None).cast("string") for c in CLUSTERING_COLUMNS if c not in rows.columns and c != "UPDATE"}
    return rows.withColumns(names).select(*CLUSTERING_COLUMNS)


def cluster_info(rows: DataFrame) -> DataFrame:
    """Size of every group."""
    return rows.groupBy("CTRL_ROWID", "FINGERPRINT").agg(F.count(F.lit(1)).alias("n")).select("FINGERPRINT", "n")


def seller_dup_ratio(rows: DataFrame) -> DataFrame:
    """Groups per listing of each seller, in single precision. Sizes are added up
    by group first, so a large seller is many partial sums."""
    groups = rows.groupBy("CTRL_ROWID", "FINGERPRINT").agg(F.count(F.lit(1)).alias("n"))
    sums = groups.groupBy("CTRL_ROWID").agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("products"))
    ratio = (F.col("clusters") / F.col("products")).cast("float").cast("double")
    return sums.select("CTRL_ROWID", ratio.alias("ratio"), "clusters", "products")


def fingerprint_runs(rows: DataFrame) -> DataFrame:
    """Runs of equal fingerprints in a seller's sorted listings: the run's number
    and length. Equal neighbours are added up before the window sees them."""
    runs = rows.groupBy("CTRL_ROWID", "FINGERPRINT").agg(F.count(F.lit(1)).alias("run_length"))
    number = F.row_number().over(Window.partitionBy("CTRL_ROWID").orderBy("FINGERPRINT")).cast("bigint")
    return runs.select("CTRL_ROWID", "FINGERPRINT", number.alias("run_no"), "run_length")
