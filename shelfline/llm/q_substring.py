"""Query of substring dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .substring_dedup import remove_repeats


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(docs).select("doc_id", "text", "removed", gone.alias("removed_chars"))


QUERIES = {"op6_substring_dedup": op6_substring_dedup}
ORACLES: dict[str, str] = {}
