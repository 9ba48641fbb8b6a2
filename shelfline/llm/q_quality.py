"""Query of the n-gram quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .ngram_quality import score_quality


def op4_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_ngram_quality": op4_ngram_quality}
ORACLES: dict[str, str] = {}
