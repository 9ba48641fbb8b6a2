"""Query of document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .winnowing import BASE, POSITION_BITS, PRIME, UNIT, K, W, digest, edited_text, hash_set, likeness, positions, winnow, with_successor


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_successor(table(spark, sf_dir, "documents"), fingerprint=True)
    # arrays are made step by step, each once for a row
    made = docs.select("doc_id", "text", "own", "next_own", edited_text(F.col("text"), F.col("next")).alias("edited"))
    made = made.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        "own", winnow(F.col("edited")).alias("changed"), hash_set(F.col("next_own")).alias("following"),
    )
    made = made.withColumn("hashes", hash_set(F.col("own")))
    return made.select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("own")).alias("fingerprint"), digest(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), hash_set(F.col("changed"))).alias("near_edited"), likeness(F.col("hashes"), F.col("following")).alias("near_next"),
        F.concat_ws(",", F.transform(positions(F.col("own")), lambda x: x.cast("string"))).alias("positions"),
    )


def _rolled(units: list[str]) -> str:
    """The polynomial over units as SQL."""
    out = units[0]
    for unit in units[1:]:
        out = f"(({out}) * {BASE} + {unit}) % {PRIME}"
    return out


_TOP = (1 << POSITION_BITS) - 1
#: The same by definition: every unit, gram and window is a row.
_SQL = f"""WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps),
docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER o, first_value(coalesce(text, '')) OVER o) AS following
  FROM documents WINDOW o AS (ORDER BY doc_id NULLS FIRST, coalesce(text, '') ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edits AS (SELECT *, substring(text, 1, length(text) - length(text) // 4) || substring(following, 1, length(text) // 4) AS edited FROM docs),
texts AS (SELECT text, row_number() OVER () AS tid FROM (SELECT text FROM edits UNION SELECT edited FROM edits)),
cut AS (SELECT tid, regexp_extract_all(text, '{UNIT}') AS units FROM texts),
words AS (SELECT DISTINCT unnest(units) AS unit FROM cut),
hashed AS (
  SELECT unit, xor(list_reduce(list_concat([4294967295::BIGINT], [('0x' || hex(encode(unit))[2 * i + 1 : 2 * i + 2])::BIGINT FOR i IN range(octet_length(encode(unit)))]),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM words, crc),
placed AS (SELECT tid, unnest(units) AS unit, unnest(range(len(units))) AS i, len(units) AS n FROM cut),
row_of AS (SELECT tid, i, n, h, {", ".join(f"lead(h, {j}) OVER p AS h{j}" for j in range(1, K))} FROM placed JOIN hashed USING (unit) WINDOW p AS (PARTITION BY tid ORDER BY i)),
grams AS (
  SELECT tid, i, CASE WHEN n >= {K} THEN {_rolled(["h", *(f"h{j}" for j in range(1, K))])} {" ".join(f"WHEN n = {m} THEN {_rolled(['h', *(f'h{j}' for j in range(1, m))])}" for m in range(1, K))} END AS h,
         greatest(n - {K - 1}, 1) AS n
  FROM row_of WHERE i = 0 OR i <= n - {K}),
packed AS (SELECT tid, i, n, h * {1 << POSITION_BITS} + ({_TOP} - i) AS p FROM grams),
chosen AS (
  SELECT DISTINCT tid, p FROM (
    SELECT tid, i, n, min(p) OVER (PARTITION BY tid ORDER BY i ROWS BETWEEN CURRENT ROW AND {W - 1} FOLLOWING) AS p FROM packed) WHERE i = 0 OR i <= n - {W}),
prints AS (
  SELECT tid, string_agg(p::VARCHAR, ',' ORDER BY {_TOP} - (p & {_TOP})) AS numbers, string_agg(({_TOP} - (p & {_TOP}))::VARCHAR, ',' ORDER BY {_TOP} - (p & {_TOP})) AS places,
         list_distinct(list(p >> {POSITION_BITS})) AS hashes
  FROM chosen GROUP BY tid),
whole AS (SELECT text, coalesce(numbers, '') AS numbers, coalesce(places, '') AS places, coalesce(hashes, []) AS hashes FROM texts LEFT JOIN prints USING (tid)),
compared AS (
  SELECT e.doc_id, length(e.text) AS n_chars, e.edited, a.numbers AS own, b.numbers AS changed, a.places, a.hashes AS x, b.hashes AS y, c.hashes AS z
  FROM edits e JOIN whole a ON a.text = e.text JOIN whole b ON b.text = e.edited JOIN whole c ON c.text = e.following)
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited) AS edited_sha256, sha256(own) AS fingerprint, sha256(changed) AS edited_fingerprint,
  CASE WHEN len(x) + len(y) = 0 THEN 1.0 ELSE len(list_intersect(x, y))::DOUBLE / (len(x) + len(y) - len(list_intersect(x, y))) END::DOUBLE AS near_edited,
  CASE WHEN len(x) + len(z) = 0 THEN 1.0 ELSE len(list_intersect(x, z))::DOUBLE / (len(x) + len(z) - len(list_intersect(x, z))) END::DOUBLE AS near_next,
  places AS positions
FROM compared"""

QUERIES = {"op9_winnowing": op9_winnowing}
ORACLES: dict[str, str] = {"op9_winnowing": _SQL}
