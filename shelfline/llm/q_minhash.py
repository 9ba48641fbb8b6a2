"""Query of MinHash near-dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .minhash import SHINGLE, SIMILAR_PERCENT, near_duplicates


def op10_minhash_bbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The same by definition: every pair of documents that share a shingle.
_SQL = rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x09-\x0D\x20]+') AS w FROM documents),
places AS (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i, len(w) AS n FROM words),
runs AS (SELECT doc_id, i, n, w, {", ".join(f"lead(w, {j}) OVER p AS w{j}" for j in range(1, SHINGLE))} FROM places WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
shingles AS (SELECT DISTINCT doc_id, concat_ws(' ', w, {", ".join(f"w{j}" for j in range(1, SHINGLE))}) AS s FROM runs WHERE i = 0 OR i <= n - {SHINGLE}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= {SIMILAR_PERCENT} * (a.n + b.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT y, root FROM reached JOIN edges ON x = id),
least AS (SELECT id, min(root) AS component_id FROM reached GROUP BY id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

QUERIES = {"op10_minhash_bbit": op10_minhash_bbit}
ORACLES: dict[str, str] = {"op10_minhash_bbit": _SQL}
