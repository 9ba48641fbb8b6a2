"""Lines of text: tab-separated rows of a fixed width, and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CLUSTERING_COLUMNS, SELLER_COLUMNS
from ..functions.text import fields_of_line, format_time, from_null_text, null_text, parse_time


def read_lines(spark: SparkSession, paths: str) -> DataFrame:
    """One column ``value``; several paths are parted by commas."""
    return spark.read.text([p for p in paths.split(",") if p])


def rows_of_lines(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lines of exactly as many fields as ``columns``; others drop out. Empty
    fields at a line's end don't count."""
    parts = lines.select(fields_of_line(F.col("value")).alias("__parts")).where(F.size("__parts") == len(columns))
    return parts.select(*[from_null_text(F.col("__parts")[i]).alias(c) for i, c in enumerate(columns)])


def read_tsv(spark: SparkSession, paths: str, columns: Sequence[str]) -> DataFrame:
    return rows_of_lines(read_lines(spark, paths), columns)


def read_clustering(spark: SparkSession, paths: str) -> DataFrame:
    """The 12-column file between jobs: times parsed, group sizes as numbers. A time
    that doesn't parse is null."""
    rows = read_tsv(spark, paths, CLUSTERING_COLUMNS)
    return rows.withColumns({c: parse_time(F.col(c)) for c in ("G_POST_TIME", "UPDATE")} | {"GROUP_NUM": F.col("GROUP_NUM").try_cast("bigint")})


def read_sellers(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, SELLER_COLUMNS)


def split_by_width(lines: DataFrame, **kinds: Sequence[str]) -> dict[str, DataFrame]:
    """Lines of mixed records, told apart by their number of fields."""
    if len({len(c) for c in kinds.values()}) < len(kinds):
        raise ValueError("records of equal width can't be told apart")
    return {name: rows_of_lines(lines, columns) for name, columns in kinds.items()}


def fields_of_json(lines: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), counters: Observation | None = None) -> DataFrame:
    """Fields of JSON objects in ``value`` as text; lines that don't parse drop out,
    an absent field is null. ``counters`` then holds how many were ``parsed`` and how
    many ``failed``, once the result has been computed."""
    schema = T.StructType([*(T.StructField(f, T.StringType()) for f in fields), T.StructField("__bad", T.StringType())])
    parsed = lines.select(*keep, F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}).alias("__json"))
    fine = F.coalesce(F.col("__json").isNotNull() & F.col("__json.__bad").isNull(), F.lit(False))
    if counters is not None:
        parsed = parsed.observe(counters, F.count_if(fine).alias("parsed"), F.count_if(~fine).alias("failed"))
    good = parsed.where(fine)
    return good.select(*keep, *[F.col(f"__json.{f}").alias(f) for f in fields])


def read_json_lines(spark: SparkSession, paths: str, fields: Sequence[str], counters: Observation | None = None) -> DataFrame:
    return fields_of_json(read_lines(spark, paths), fields, counters=counters)


def lines_of_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One tab-separated column ``value``; nulls in their written form, times in the
    form that :func:`parse_time` reads."""

    def written(c: str) -> Column:
        return null_text(format_time(F.col(c)) if df.schema[c].dataType.typeName().startswith("timestamp") else F.col(c))

    return df.select(F.concat_ws("\t", *[written(c) for c in columns or df.columns]).alias("value"))
