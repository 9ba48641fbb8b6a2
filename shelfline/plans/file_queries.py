"""Queries that go through files: what is written is read back and must equal the
tables it came from. Their folders lie below the session's shared folder."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import CLUSTERING_COLUMNS, SELLER_COLUMNS, SHARD_BOUNDS, Settings
from ..functions.hashes import murmur3, routed, shard
from ..functions.text import format_time, millis, parse_time
from ..operators import clustering, eligibility
from ..sources import sequence_files, sinks, text_files
from ..sources.scratch import scratch
from . import fixtures, jobs
from .oracle import _DELTA, _GOODS, _PRINTED

_ROW = ("G_NO", "CTRL_ROWID", "G_NAME")


def sequence_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sequence")
    sequence_files.write_sequence(fixtures.goods(spark, sf_dir).select(*_ROW, "IS_DELETE"), path)
    return sequence_files.read_sequence(spark, path, (*_ROW, "IS_DELETE"))


def clustering_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12-column file in two folders, read as one list of paths."""
    base = sinks.run_path(scratch(spark, "clustering"), "run")
    rows = clustering.stamped(clustering.fingerprinted(fixtures.eligible(spark, sf_dir)), Settings())
    even = F.col("G_NO").cast("bigint") % 2 == 0
    for part, chosen in (("even", even), ("odd", ~even)):
        sinks.write_tsv(rows.where(chosen), f"{base}/{part}", CLUSTERING_COLUMNS)
    back = text_files.read_clustering(spark, f"{base}/even,{base}/odd")
    return back.select(*_ROW, "RANK", millis(F.col("G_POST_TIME")).alias("POST_MS"), "GROUP_HEAD", "GROUP_NUM", "FINGERPRINT", millis(F.col("UPDATE")).alias("UPDATE_MS"))


def records_by_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of four and of two fields in one file."""
    path = scratch(spark, "widths")
    sellers = fixtures.sellers(spark, sf_dir).select(F.concat_ws("\t", "CTRL_ROWID", "APPLY_STATUS").alias("value"))
    fixtures.tsv_lines(spark, sf_dir).unionByName(sellers).write.text(path)
    found = text_files.split_by_width(text_files.read_lines(spark, path), order=("NO", "STATUS", "PRIORITY", "SELLER"), seller=("NO", "STATUS"))
    return found["order"].select(F.lit("order").alias("KIND"), "NO", "STATUS").unionByName(found["seller"].select(F.lit("seller").alias("KIND"), "NO", "STATUS"))


def seller_file_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sellers")
    rows = fixtures.sellers(spark, sf_dir).withColumns({"ASD_WEIGHT": F.lit("1"), "_SOURCE_TIME": F.lit("t")})
    sinks.write_tsv(rows, path, SELLER_COLUMNS)
    return eligibility.excluded_sellers(text_files.read_sellers(spark, path))


def clustering_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group sizes and sellers' ratios as read from the three outputs of one pass."""
    base = scratch(spark, "outputs")
    sinks.write_clustering(fixtures.eligible(spark, sf_dir), base)
    result = text_files.read_clustering(spark, f"{base}/result").groupBy("FINGERPRINT", "CTRL_ROWID").agg(F.count(F.lit(1)).alias("n"))
    sizes = text_files.read_tsv(spark, f"{base}/clusterInfo", ("FINGERPRINT", "size"))
    info = text_files.read_tsv(spark, f"{base}/info", ("CTRL_ROWID", "ratio", "clusters", "products"))
    typed = info.select("CTRL_ROWID", F.col("ratio").cast("double").alias("ratio"), F.col("products").cast("bigint").alias("products"))
    return result.join(sizes, "FINGERPRINT").join(typed, "CTRL_ROWID").select("FINGERPRINT", "n", F.col("size").cast("bigint").alias("size"), "CTRL_ROWID", "ratio", "products")


def product_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, cluster, refine and delta, each from the files of the one before, for
    the old and the current snapshot."""
    base = scratch(spark, "run")
    number = F.col("G_NO").cast("bigint")
    jobs.filter_job(fixtures.goods(spark, sf_dir), fixtures.ads(spark, sf_dir), fixtures.ranks(spark, sf_dir), fixtures.sellers(spark, sf_dir), f"{base}/eligible")
    eligible = spark.read.parquet(f"{base}/eligible")
    renamed = F.when(number % 17 == 0, "renamed").otherwise(F.col("G_NAME"))
    eligible.where((number % 19 != 0) & (number % 23 != 1)).withColumn("G_NAME", renamed).write.parquet(f"{base}/eligible-old")
    now = replace(Settings(), batch_ts=datetime(2024, 1, 2))
    for source, name, settings in (("eligible-old", "old", Settings()), ("eligible", "new", now)):
        jobs.cluster_job(spark, f"{base}/{source}", f"{base}/{name}", settings)
        jobs.refine_job(spark, f"{base}/{name}/result", f"{base}/{name}/refined")
    # the current snapshot lacks some of its listings
    lines = text_files.read_clustering(spark, f"{base}/new/refined").where(number % 29 != 0)
    sinks.write_tsv(lines, f"{base}/new/current", CLUSTERING_COLUMNS)
    delta = jobs.delta_job(spark, f"{base}/new/current", f"{base}/old/refined")
    return delta.select("G_NO", "FINGERPRINT", "HEAD", "GROUP_NUM", "IS_OLD", "ACTION")


def index_sink_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index receives: every document once, in requests of 1000 at most."""
    folder = scratch(spark, "index")
    docs = jobs.update_docs(fixtures_delta(spark, sf_dir), Settings())

    def send(collection: str, body: str) -> None:
        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"collection": collection, "size": len(json.loads(body)), "body": json.loads(body)}).encode())

    sinks.send_documents(docs, send, sinks.collection_name("all", {"all": "main"}), Settings(pause_seconds=0))
    schema = "collection string, size int, body array<struct<id: string, GROUP_TAG: struct<set: string>, GROUP_NUM: struct<set: bigint>>>"
    found = spark.read.schema(schema).json(folder).where("size <= 1000").select("collection", F.inline("body"))
    return found.select("collection", "id", F.col("GROUP_TAG.set").alias("tag"), F.col("GROUP_NUM.set").alias("num"))


def fixtures_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.delta import group_delta

    return group_delta(fixtures.snapshots(spark, sf_dir))


def greatest_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.table(spark, sf_dir, "lineitem")
    return eligibility.greatest_ranks(lines.select(F.col("l_orderkey").cast("string").alias("G_NO"), F.col("l_quantity").cast("int").cast("string").alias("RANK")))


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "events").select("event_id", format_time(F.col("ts")).alias("written"))
    return rows.withColumn("ms", millis(parse_time(F.col("written"))))


def shard_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and writer of each key, and that a writer's rows are one partition."""
    rows = routed(fixtures.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("KEY")), "KEY")
    found = rows.select("KEY", murmur3("KEY").alias("HASH"), F.col("SUB_SHARD"), (F.spark_partition_id() == F.col("SUB_SHARD")).alias("OWN_PARTITION"))
    return found.withColumn("SHARD", shard(F.col("HASH")))


def parse_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines parsed and failed, counted while they were read."""
    path = scratch(spark, "lines")
    event = fixtures.table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props")).alias("value"))
    event.write.text(path)
    counters = Observation()
    good = text_files.read_json_lines(spark, path, ("k",), counters)
    kept = good.count()
    found = counters.get
    return spark.createDataFrame([(found["parsed"], found["failed"], kept)], "parsed bigint, failed bigint, kept bigint")


_BYTES = "[('0x' || hex(encode(k))[2 * i + 1 : 2 * i + 2])::BIGINT FOR i IN range(octet_length(encode(k)))]"
_FULL = 1 << 32


def _times(x: str, factor: int) -> str:
    return f"(({x})::HUGEINT * {factor} % {_FULL})::BIGINT"


def _turn(x: str, r: int) -> str:
    return f"(({x}) * {1 << r} % {_FULL} + ({x}) // {1 << (32 - r)})"


#: The public 32-bit MurmurHash3 in steps of a column each.
_MURMUR = f"""keys AS (SELECT c_custkey::VARCHAR AS k FROM customer),
bytes AS (SELECT k, {_BYTES} AS b FROM keys),
words AS (SELECT k, len(b) AS n, [b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216 FOR i IN range(len(b) // 4)] AS w,
  coalesce(b[len(b) // 4 * 4 + 1], 0) + coalesce(b[len(b) // 4 * 4 + 2], 0) * 256 + coalesce(b[len(b) // 4 * 4 + 3], 0) * 65536 AS rest FROM bytes),
mixed AS (SELECT k, n, [{_times(_turn(_times("x", 0xCC9E2D51), 15), 0x1B873593)} FOR x IN w] AS w, {_times(_turn(_times("rest", 0xCC9E2D51), 15), 0x1B873593)} AS rest FROM words),
body AS (SELECT k, n, rest, list_reduce(list_concat([0::BIGINT], w), lambda h, x: ({_turn("xor(h, x)", 13)} * 5 + {0xE6546B64}) % {_FULL}) AS h FROM mixed),
one AS (SELECT k, xor(xor(h, rest), n) AS h FROM body),
two AS (SELECT k, {_times("xor(h, h >> 16)", 0x85EBCA6B)} AS h FROM one),
three AS (SELECT k, {_times("xor(h, h >> 13)", 0xC2B2AE35)} AS h FROM two),
four AS (SELECT k, xor(h, h >> 16) AS h FROM three),
hashes AS (SELECT k, CASE WHEN h >= {1 << 31} THEN h - {_FULL} ELSE h END AS h, h & {0x7FFFFFFF} AS low FROM four),
shards AS (SELECT k, h, low, len([b FOR b IN {list(SHARD_BOUNDS)} IF h > b]) AS shard FROM hashes)"""

QUERIES = {
    f.__name__: f
    for f in (
        sequence_round_trip, clustering_file_round_trip, records_by_width, seller_file_exclusion, clustering_outputs, product_run, index_sink_documents,
        greatest_ranks, time_texts, shard_routes, parse_counters,
    )
}

ORACLES = {
    "sequence_round_trip": f"WITH {_GOODS} SELECT G_NO, CTRL_ROWID, G_NAME, IS_DELETE FROM goods",
    "clustering_file_round_trip": f"""WITH {_PRINTED} SELECT G_NO, CTRL_ROWID, G_NAME, RANK, POST_MS, NULL::VARCHAR AS GROUP_HEAD, NULL::BIGINT AS GROUP_NUM, FINGERPRINT,
        epoch_ms(TIMESTAMP '2024-01-01') AS UPDATE_MS FROM printed""",
    "records_by_width": """SELECT 'order' AS KIND, o_orderkey::VARCHAR AS "NO", o_orderstatus AS STATUS FROM orders WHERE o_orderkey % 7 <> 0
        UNION ALL SELECT 'seller', c_custkey::VARCHAR, CASE c_mktsegment WHEN 'BUILDING' THEN 'a' ELSE 'C' END FROM customer""",
    "seller_file_exclusion": "SELECT DISTINCT c_custkey::VARCHAR AS CTRL_ROWID FROM customer WHERE c_mktsegment = 'BUILDING'",
    "clustering_outputs": f"""WITH {_PRINTED}, sizes AS (SELECT CTRL_ROWID, FINGERPRINT, count(*) AS n FROM printed GROUP BY ALL),
        sellers AS (SELECT CTRL_ROWID, (count(*)::DOUBLE / sum(n))::FLOAT::DOUBLE AS ratio, sum(n)::BIGINT AS products FROM sizes GROUP BY CTRL_ROWID)
        SELECT FINGERPRINT, n, n AS size, CTRL_ROWID, ratio, products FROM sizes JOIN sellers USING (CTRL_ROWID)""",
    "product_run": f"WITH {_DELTA} SELECT G_NO, FINGERPRINT, HEAD, GROUP_NUM, IS_OLD, ACTION FROM delta WHERE ACTION IS NOT NULL",
    "index_sink_documents": f"""WITH {_DELTA} SELECT 'main' AS collection, G_NO AS id, CASE WHEN ACTION <> 'delete' THEN FINGERPRINT END AS tag,
        CASE WHEN ACTION <> 'delete' THEN GROUP_NUM END AS num FROM delta WHERE ACTION IS NOT NULL""",
    "greatest_ranks": "SELECT l_orderkey::VARCHAR AS G_NO, max(l_quantity::INT)::VARCHAR AS RANK FROM lineitem GROUP BY l_orderkey",
    "time_texts": "SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS written, epoch_ms(date_trunc('millisecond', ts)) AS ms FROM events",
    "shard_routes": f"WITH {_MURMUR} SELECT k AS KEY, h::INT AS HASH, (shard + low % 3 * 12)::INT AS SUB_SHARD, true AS OWN_PARTITION, shard::INT AS SHARD FROM shards",
    "parse_counters": """SELECT count(*) FILTER (event_id % 7 <> 0 AND json_valid(props)) AS parsed, count(*) FILTER (event_id % 7 = 0 OR NOT json_valid(props)) AS failed,
        count(*) FILTER (event_id % 7 <> 0 AND json_valid(props)) AS kept FROM events""",
}
