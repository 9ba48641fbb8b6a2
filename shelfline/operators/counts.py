"""Counts of lines by their first tab-separated column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by_first_col(lines: DataFrame) -> DataFrame:
    """(key, n); an empty line has the empty key."""
    return lines.groupBy(F.split("value", "\t", 2)[0].alias("key")).agg(F.count(F.lit(1)).alias("n"))
