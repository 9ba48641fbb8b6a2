"""The four jobs of a product run, each from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import CLUSTERING_COLUMNS, Settings
from ..operators.delta import group_delta, index_update_docs, snapshot_union
from ..operators.eligibility import eligible_goods
from ..operators.refine import group_refine
from ..sources.sinks import write_clustering, write_tsv
from ..sources.text_files import read_clustering


def filter_job(goods: DataFrame, ads: DataFrame, ranks: DataFrame, sellers: DataFrame, out: str) -> None:
    """Eligible listings."""
    eligible_goods(goods, ads, ranks, sellers).write.mode("overwrite").parquet(out)


def cluster_job(spark: SparkSession, eligible: str, out: str, settings: Settings) -> None:
    """Their fingerprints, group sizes and sellers' ratios, below ``out``."""
    write_clustering(spark.read.parquet(eligible), out, settings)


def refine_job(spark: SparkSession, paths: str, out: str) -> None:
    """Sizes and heads, in the same 12 columns; an output that exists is refused."""
    refined = group_refine(read_clustering(spark, paths))
    write_tsv(refined, out, CLUSTERING_COLUMNS, overwrite=False)


def delta_job(spark: SparkSession, current: str, old: str | None) -> DataFrame:
    """What changed since the refined file ``old``; all of ``current`` without one."""
    now = read_clustering(spark, current)
    return group_delta(snapshot_union(now, read_clustering(spark, old) if old else now.limit(0)))


def update_docs(delta: DataFrame, settings: Settings) -> DataFrame:
    return index_update_docs(delta, settings.batch_ts)
