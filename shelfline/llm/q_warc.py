"""Query of the ZIP-packaged WARC archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .warc_zip import archive_round_trip


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return archive_round_trip(pages, min_bytes=0).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 of a SHA-1: each 5 of its 40 hex digits are 4 letters.
_SQL = """WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digests AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS head FROM payloads)
SELECT page_id, n::BIGINT AS payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::INT >> (5 * (3 - i % 4))) & 31) + 1, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> head THEN head END AS refers_to
FROM digests"""

QUERIES = {"op2_warc_zip": op2_warc_zip}
ORACLES: dict[str, str] = {"op2_warc_zip": _SQL}
