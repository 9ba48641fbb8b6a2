"""Query of the media columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .media import TILE, WIDTH, encode_text, media_features, npy_tile


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stored = encode_text(docs, "text", ("doc_id",))
    return media_features(stored, "media", ("doc_id", "n_bytes")).selectExpr(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
        "dhash AS feature", "length(tile) AS tile_bytes", "crc32(tile) AS tile_crc32",
    )


ROWS, COLS = TILE
_HEAD = list(npy_tile(np.zeros(TILE))[: -4 * ROWS * COLS])


def _crc(numbers: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {numbers}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


#: The same by definition: every byte is a row, and every cell a sum over the parts of bytes in it.
_SQL = f"""WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps),
docs AS (SELECT doc_id, encode(coalesce(text, '')) AS data, greatest(1, (octet_length(encode(coalesce(text, ''))) + {WIDTH - 1}) // {WIDTH}) AS h FROM documents),
payloads AS (SELECT doc_id, octet_length(data) AS n, h, data || unhex(repeat('00', (h * {WIDTH} - octet_length(data))::INT)) AS payload FROM docs),
media AS (SELECT *, encode('P5' || chr(10) || '{WIDTH} ' || h || chr(10) || '255' || chr(10)) || payload AS media FROM payloads),
lines AS (SELECT doc_id, h, unnest(regexp_extract_all(hex(payload), '.{{{2 * WIDTH}}}')) AS line, unnest(range(h)) AS y FROM payloads),
samples AS (SELECT doc_id, h, y, unnest([('0x' || line[2 * x + 1 : 2 * x + 2])::BIGINT FOR x IN range({WIDTH})]) AS v, unnest(range({WIDTH})) AS x FROM lines),
tails AS (SELECT doc_id, list(v ORDER BY x) AS b FROM samples WHERE y = h - 1 GROUP BY doc_id),
across AS (
  SELECT x, j, least({COLS} * (x + 1), (j + 1) * {WIDTH}) - greatest({COLS} * x, j * {WIDTH}) AS part
  FROM (SELECT unnest(range({WIDTH})) AS x), (SELECT unnest(range({COLS})) AS j)),
rows_cut AS (SELECT doc_id, h, y, j, sum(v * part)::BIGINT AS v FROM samples JOIN (SELECT * FROM across WHERE part > 0) USING (x) GROUP BY ALL),
cells AS (
  SELECT doc_id, h, i, j, sum(v * (least({ROWS} * (y + 1), (i + 1) * h) - greatest({ROWS} * y, i * h)))::BIGINT AS v
  FROM rows_cut JOIN (SELECT unnest(range({ROWS})) AS i) ON least({ROWS} * (y + 1), (i + 1) * h) > greatest({ROWS} * y, i * h) GROUP BY ALL),
edges AS (SELECT *, lead(v) OVER (PARTITION BY doc_id, i ORDER BY j) > v AS darker, (v::DOUBLE / (h * {WIDTH}))::FLOAT::DOUBLE AS mean FROM cells),
bits AS (SELECT *, CASE WHEN mean > 0 THEN floor(log2(mean))::INT ELSE 0 END AS e FROM edges),
words AS (SELECT *, CASE WHEN mean > 0 THEN (e + 127) * 8388608 + ((mean / pow(2, e) - 1) * 8388608)::BIGINT ELSE 0 END AS word FROM bits),
hashes AS (SELECT doc_id, string_agg(printf('%02x', b::INT), '' ORDER BY i) AS feature FROM (
  SELECT doc_id, i, sum(CASE WHEN darker THEN 1 << (7 - j) ELSE 0 END) AS b FROM words WHERE j < {COLS - 1} GROUP BY ALL) GROUP BY doc_id),
tiles AS (SELECT doc_id, flatten(list([word & 255, (word >> 8) & 255, (word >> 16) & 255, word >> 24] ORDER BY i, j)) AS b FROM words GROUP BY doc_id)
SELECT m.doc_id, n::BIGINT AS n_bytes, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_sha256, {_crc("tails.b")}::BIGINT AS tail_crc32,
  octet_length(media)::BIGINT AS media_bytes, sha256(media) AS media_sha256, feature, {len(_HEAD) + 4 * ROWS * COLS} AS tile_bytes,
  {_crc(f"list_concat({_HEAD}::BIGINT[], tiles.b)")}::BIGINT AS tile_crc32
FROM media m JOIN tails USING (doc_id) JOIN hashes USING (doc_id) JOIN tiles USING (doc_id), crc"""

QUERIES = {"op7_media_columns": op7_media_columns}
ORACLES: dict[str, str] = {"op7_media_columns": _SQL}
