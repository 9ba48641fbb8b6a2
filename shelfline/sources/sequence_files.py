"""Sequence files of (key, map of text), for exchange with older jobs. This edge
alone uses RDDs, as Spark has no DataFrame reader for the format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_sequence(spark: SparkSession, path: str, columns: Sequence[str], key: str = "G_NO") -> DataFrame:
    """Key and the named fields of each map; an absent field is null."""
    names = [c for c in columns if c != key]
    rows = spark.sparkContext.sequenceFile(path).map(lambda kv: (str(kv[0]), *(None if kv[1].get(c) is None else str(kv[1][c]) for c in names)))
    return spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in (key, *names)]))


def write_sequence(df: DataFrame, path: str, key: str = "G_NO") -> None:
    names = [c for c in df.columns if c != key]
    typed = df.select(*[df[c].cast("string") for c in (key, *names)])
    typed.rdd.map(lambda r: (r[0], {c: r[i + 1] for i, c in enumerate(names)})).saveAsSequenceFile(path)
