"""DuckDB SQL for the catalogue queries, written from their definitions."""

from __future__ import annotations

_GOODS = """goods AS (
  SELECT o_orderkey AS k, o_orderkey::VARCHAR AS G_NO, o_custkey::VARCHAR AS CTRL_ROWID, o_orderpriority || ' ' || o_orderstatus AS G_NAME,
         epoch_ms(o_orderdate) AS POST_MS, o_totalprice AS G_DIRECT_PRICE,
         CASE o_orderkey % 10 WHEN 0 THEN '5' WHEN 1 THEN '0' WHEN 2 THEN '' END AS G_PRIORITY_ORDER,
         CASE o_orderkey % 11 WHEN 0 THEN '2020-01-01' WHEN 1 THEN '' END AS G_CLOSE_DATE,
         CASE o_orderkey % 13 WHEN 0 THEN 'y' WHEN 1 THEN 'N' END AS IS_DELETE
  FROM orders)"""
_EXCLUDED = "excluded AS (SELECT DISTINCT c_custkey::VARCHAR AS CTRL_ROWID FROM customer WHERE c_mktsegment = 'BUILDING')"
_ADS = """ads AS (
  SELECT l_orderkey::VARCHAR AS G_NO, o_custkey::VARCHAR AS CTRL_ROWID, l_returnflag AS B_STATUS, (l_linenumber - 1)::VARCHAR AS B_COIN
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount = 0.0)"""
_LISTED = "listed AS (SELECT * FROM goods WHERE k % 10 <> 0 AND k % 11 <> 0 AND k % 13 <> 0)"
_ELIGIBLE = f"""{_GOODS}, {_EXCLUDED}, {_ADS}, {_LISTED},
running AS (SELECT G_NO FROM ads WHERE B_STATUS IN ('r', 'R') AND B_COIN <> '0' AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e.CTRL_ROWID = ads.CTRL_ROWID)),
ranks AS (
  SELECT l_orderkey::VARCHAR AS G_NO, max(l_quantity)::INT::VARCHAR AS RANK, max(o_custkey::VARCHAR) AS CTRL_ROWID
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 3 <> 0 GROUP BY l_orderkey),
eligible AS (
  SELECT listed.*, ranks.RANK FROM listed
  LEFT JOIN ranks ON ranks.G_NO = listed.G_NO AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e.CTRL_ROWID = ranks.CTRL_ROWID)
  WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.CTRL_ROWID = listed.CTRL_ROWID) AND NOT EXISTS (SELECT 1 FROM running r WHERE r.G_NO = listed.G_NO))"""
_PRINTED = f"{_ELIGIBLE}, printed AS (SELECT *, sha1(CTRL_ROWID || ',' || G_NAME) AS FINGERPRINT FROM eligible)"


def _refine(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, count(*) OVER (PARTITION BY FINGERPRINT) AS GROUP_NUM,
         CASE WHEN row_number() OVER (PARTITION BY FINGERPRINT ORDER BY RANK::DOUBLE DESC NULLS LAST, POST_MS DESC, G_NO::BIGINT DESC) = 1 THEN 'Y' ELSE 'N' END AS GROUP_HEAD
  FROM {source})"""


_REFINED = f"{_PRINTED}, {_refine('printed', 'refined')}"
_SNAPSHOTS = f"""{_REFINED},
reprinted AS (
  SELECT *, sha1(CTRL_ROWID || ',' || CASE WHEN k % 17 = 0 THEN 'renamed' ELSE G_NAME END) AS FINGERPRINT
  FROM eligible WHERE k % 19 <> 0 AND k % 23 <> 1), {_refine("reprinted", "before")},
snapshots AS (
  SELECT G_NO, FINGERPRINT, GROUP_HEAD, GROUP_NUM, 2::INT AS "UPDATE", 'N' AS IS_OLD FROM refined WHERE k % 29 <> 0
  UNION ALL SELECT G_NO, FINGERPRINT, GROUP_HEAD, GROUP_NUM, 1::INT, 'Y' FROM before)"""
#: In these snapshots every listing has at most one row of each, and the current one is newer.
_DELTA = f"""{_SNAPSHOTS},
delta AS (
  SELECT coalesce(n.G_NO, o.G_NO) AS G_NO, coalesce(n.FINGERPRINT, o.FINGERPRINT) AS FINGERPRINT, coalesce(n.GROUP_HEAD, o.GROUP_HEAD) = 'Y' AS HEAD,
         coalesce(n.GROUP_NUM, o.GROUP_NUM) AS GROUP_NUM, coalesce(n.IS_OLD, o.IS_OLD) AS IS_OLD,
         CASE WHEN n.G_NO IS NULL THEN 'delete'
              WHEN o.G_NO IS NULL THEN CASE WHEN n.GROUP_NUM > 1 THEN 'insert' END
              WHEN n.GROUP_NUM > 1 AND o.GROUP_NUM > 1 THEN CASE WHEN n.FINGERPRINT <> o.FINGERPRINT OR n.GROUP_HEAD <> o.GROUP_HEAD THEN 'update' END
              WHEN n.GROUP_NUM > 1 THEN 'insert' WHEN o.GROUP_NUM > 1 THEN 'delete' END AS ACTION
  FROM (SELECT * FROM snapshots WHERE IS_OLD = 'N') n FULL JOIN (SELECT * FROM snapshots WHERE IS_OLD = 'Y') o ON n.G_NO = o.G_NO)"""
_IMAGES = """base AS (
  SELECT vec_id AS id, lpad(to_hex(list_aggregate([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding], 'string_agg', '')::BIT::UBIGINT), 16, '0') AS h0
  FROM embeddings),
based AS (SELECT id, lower(h0) AS h FROM base),
images AS (
  SELECT id::VARCHAR AS gno, h FROM based
  UNION ALL SELECT (id + 1000000)::VARCHAR, h[1:15] || '0' FROM based WHERE id % 2 = 0
  UNION ALL SELECT (id + 2000000)::VARCHAR, h[1:6] || 'f' || h[8:16] FROM based WHERE id % 3 = 0)"""


def _bands(digits: int) -> str:
    return f"""{_IMAGES},
short AS (SELECT gno, h AS full_hash, CASE WHEN ltrim(h, '0') = '' THEN '0' ELSE ltrim(h, '0') END AS hash FROM images),
cut AS (SELECT gno, full_hash, hash, unnest([full_hash[16 - {digits} * (i + 1) + 1 : 16 - {digits} * i] FOR i IN range({16 // digits})]) AS raw FROM short),
banded AS (SELECT CASE WHEN ltrim(raw, '0') = '' THEN '0' ELSE ltrim(raw, '0') END AS band, hash, gno, full_hash FROM cut)"""


def _distance(a: str, b: str) -> str:
    return f"bit_count(xor(('0x' || {a})::UBIGINT, ('0x' || {b})::UBIGINT)::BIT)"


def _clusters(digits: int) -> str:
    return f"""WITH RECURSIVE {_bands(digits)},
hashes AS (SELECT band, hash, count(*) AS n, row_number() OVER (PARTITION BY band ORDER BY hash) AS i FROM banded GROUP BY band, hash),
scan AS (
  SELECT band, i, hash, hash AS leader, n FROM hashes WHERE i = 1
  UNION ALL
  SELECT h.band, h.i, h.hash, CASE WHEN {_distance("h.hash", "s.leader")} < 10 THEN s.leader ELSE h.hash END, h.n
  FROM scan s JOIN hashes h ON h.band = s.band AND h.i = s.i + 1),
large AS (SELECT band, leader FROM scan GROUP BY band, leader HAVING sum(n) >= 2),
labels AS (SELECT DISTINCT hash, leader FROM scan JOIN large USING (band, leader))
SELECT DISTINCT gno, leader FROM short JOIN labels USING (hash)"""


ORACLES = {
    "scan_tsv_arity": """SELECT o_orderkey::VARCHAR AS ORDER_NO, o_orderstatus AS STATUS, o_orderpriority AS PRIORITY, o_custkey::VARCHAR AS SELLER
        FROM orders WHERE o_orderkey % 7 <> 0""",
    "json_scan_props": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_valid(props)",
    "active_ads": f"WITH {_ADS} SELECT * FROM ads WHERE B_STATUS IN ('r', 'R') AND B_COIN <> '0'",
    "eligible_listing_filter": f"WITH {_GOODS}, {_LISTED} SELECT G_NO, CTRL_ROWID, G_NAME, G_PRIORITY_ORDER, G_CLOSE_DATE, IS_DELETE FROM listed",
    "seller_exclusion": f"WITH {_EXCLUDED} SELECT CTRL_ROWID FROM excluded",
    "seller_anti_join": f"WITH {_GOODS}, {_EXCLUDED} SELECT G_NO, CTRL_ROWID, G_NAME FROM goods WHERE CTRL_ROWID NOT IN (SELECT CTRL_ROWID FROM excluded)",
    "eligible_goods": f"""WITH {_ELIGIBLE} SELECT G_NO, CTRL_ROWID, G_NAME, coalesce(RANK, '(null)') AS RANK, POST_MS, '(null)' AS G_CLASS,
        '(null)' AS G_LASTUPDATE, G_DIRECT_PRICE FROM eligible""",
    "fingerprint_result": f"WITH {_PRINTED} SELECT G_NO, CTRL_ROWID, G_NAME, RANK, POST_MS, FINGERPRINT FROM printed",
    "cluster_info": f"WITH {_PRINTED} SELECT FINGERPRINT, count(*) AS n FROM printed GROUP BY CTRL_ROWID, FINGERPRINT",
    "seller_dup_ratio": f"""WITH {_PRINTED} SELECT CTRL_ROWID, (count(DISTINCT FINGERPRINT)::DOUBLE / count(*))::FLOAT::DOUBLE AS ratio,
        count(DISTINCT FINGERPRINT) AS clusters, count(*) AS products FROM printed GROUP BY CTRL_ROWID""",
    "fingerprint_runs": f"""WITH {_PRINTED}, steps AS (
        SELECT *, lag(FINGERPRINT) OVER (PARTITION BY CTRL_ROWID ORDER BY FINGERPRINT) IS DISTINCT FROM FINGERPRINT AS fresh FROM printed),
        numbered AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY CTRL_ROWID ORDER BY FINGERPRINT RANGE UNBOUNDED PRECEDING)::BIGINT AS run_no FROM steps)
        SELECT CTRL_ROWID, FINGERPRINT, run_no, count(*) AS run_length FROM numbered GROUP BY ALL""",
    "group_refine": f"WITH {_REFINED} SELECT G_NO, CTRL_ROWID, G_NAME, RANK, POST_MS, GROUP_HEAD, GROUP_NUM, FINGERPRINT FROM refined",
    "group_heads": f"WITH {_REFINED} SELECT FINGERPRINT, G_NO, GROUP_NUM FROM refined WHERE GROUP_HEAD = 'Y'",
    "snapshot_union": f"WITH {_SNAPSHOTS} SELECT * FROM snapshots",
    "snapshot_top2": f"""WITH {_SNAPSHOTS} SELECT *, row_number() OVER (PARTITION BY G_NO ORDER BY "UPDATE" DESC) AS rn FROM snapshots
        QUALIFY row_number() OVER (PARTITION BY G_NO ORDER BY "UPDATE" DESC) <= 2""",
    "group_delta": f"WITH {_DELTA} SELECT G_NO, FINGERPRINT, HEAD, GROUP_NUM, IS_OLD, ACTION FROM delta WHERE ACTION IS NOT NULL",
    "index_update_docs": f"""WITH {_DELTA} SELECT G_NO, ACTION,
        '{{"id":"' || G_NO || '","GROUP_TAG":{{"set":' || CASE ACTION WHEN 'delete' THEN 'null' ELSE '"' || FINGERPRINT || '"' END
        || '}},"GROUP_HEAD":{{"set":' || CASE ACTION WHEN 'delete' THEN 'null' ELSE HEAD::VARCHAR END
        || '}},"GROUP_NUM":{{"set":' || CASE ACTION WHEN 'delete' THEN 'null' ELSE GROUP_NUM::VARCHAR END
        || '}},"_IMPORT":{{"add":"group_tag.20240101000000"}},"_SOURCE_TIME":{{"add":"2024-01-01T00:00:00Z"}}}}' AS doc FROM delta WHERE ACTION IS NOT NULL""",
    "exact_hash_dups": f"""WITH {_IMAGES}, short AS (SELECT gno, CASE WHEN ltrim(h, '0') = '' THEN '0' ELSE ltrim(h, '0') END AS hash FROM images)
        SELECT hash, gno FROM short QUALIFY count(*) OVER (PARTITION BY hash) >= 2""",
    "image_band_candidates": f"WITH {_bands(4)} SELECT band, hash, gno FROM banded QUALIFY count(*) OVER (PARTITION BY band) >= 2",
    "hamming_pairs": f"""WITH {_bands(4)}, hashes AS (SELECT DISTINCT band, hash FROM banded),
        pairs AS (SELECT *, lag(hash) OVER (PARTITION BY band ORDER BY hash) AS before FROM hashes)
        SELECT band, hash, before, {_distance("hash", "before")}::BIGINT AS distance FROM pairs WHERE before IS NOT NULL AND {_distance("hash", "before")} < 10""",
    "image_clusters": _clusters(4),
    "image_clusters_fine": _clusters(2),
    "image_clusters_sorted": f"SELECT leader, gno FROM ({_clusters(4)}) ORDER BY leader, gno",
    "count_by_first_col": "SELECT source AS key, count(*) AS n FROM documents GROUP BY source",
}
