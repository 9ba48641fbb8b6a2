"""Columns of text: null forms, tab-separated lines, times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NULL_TEXT

TIME_PATTERN = r"^(\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2})\.(\d+)Z"


def null_text(c: Column) -> Column:
    """The column as text, with the written form of null."""
    return F.coalesce(c.cast("string"), F.lit(NULL_TEXT))


def from_null_text(c: Column) -> Column:
    return F.nullif(c, F.lit(NULL_TEXT))


def same_text(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def fields_of_line(line: Column) -> Column:
    """Fields of a tab-separated line, without empty ones at its end."""
    return F.split(F.regexp_replace(line, "\t+$", ""), "\t")


def parse_time(c: Column) -> Column:
    """Timestamp of yyyy-MM-ddTHH:mm:ss.NZ, where N is a number of milliseconds and
    no fraction: .7 is 7 ms. Null where the text doesn't parse."""
    seconds = F.try_to_timestamp(F.regexp_extract(c, TIME_PATTERN, 1), F.lit("yyyy-M-d'T'H:m:s"))
    return F.timestamp_millis(F.unix_millis(seconds) + F.regexp_extract(c, TIME_PATTERN, 2).try_cast("bigint"))


def format_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def millis(c: Column) -> Column:
    """Milliseconds since the epoch of a timestamp with or without a zone."""
    return F.unix_millis(c.cast("timestamp"))
