"""Inputs of the catalogue operators, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clustering import fingerprinted
from ..operators.delta import snapshot_union
from ..operators.eligibility import eligible_goods
from ..operators.refine import group_refine
from ..sources.scratch import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("G_NO"), F.col("o_custkey").cast("string").alias("CTRL_ROWID"), F.lit(None).cast("string").alias("G_CLASS"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("G_NAME"), F.col("o_orderdate").cast("timestamp").alias("G_POST_TIME"),
        F.lit(None).cast("string").alias("G_LASTUPDATE"), F.col("o_totalprice").alias("G_DIRECT_PRICE"),
        F.when(key % 10 == 0, "5").when(key % 10 == 1, "0").when(key % 10 == 2, "").alias("G_PRIORITY_ORDER"),
        F.when(key % 11 == 0, "2020-01-01").when(key % 11 == 1, "").alias("G_CLOSE_DATE"), F.when(key % 13 == 0, "y").when(key % 13 == 1, "N").alias("IS_DELETE"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("c_mktsegment") == "BUILDING", "a").otherwise("C")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("CTRL_ROWID"), status.alias("APPLY_STATUS"))


def _ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").cast("string").alias("CTRL_ROWID"))
    return lines.join(orders, "l_orderkey").withColumn("G_NO", F.col("l_orderkey").cast("string"))


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    free = _ordered_lines(spark, sf_dir).where("l_discount = 0.0")
    return free.select("G_NO", "CTRL_ROWID", F.col("l_returnflag").alias("B_STATUS"), (F.col("l_linenumber") - 1).cast("string").alias("B_COIN"))


def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ordered_lines(spark, sf_dir).where("l_orderkey % 3 <> 0")
    return rows.groupBy("G_NO").agg(F.max("l_quantity").cast("int").cast("string").alias("RANK"), F.max("CTRL_ROWID").alias("CTRL_ROWID"))


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible_goods(goods(spark, sf_dir), ads(spark, sf_dir), ranks(spark, sf_dir), sellers(spark, sf_dir))


def refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_refine(fingerprinted(eligible(spark, sf_dir)))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current and old snapshot, one above the other."""
    number = F.col("G_NO").cast("bigint")
    path = scratch(spark, "eligible")  # both snapshots begin with it
    base = eligible(spark, sf_dir)
    base.write.parquet(path)
    base = spark.read.schema(base.schema).parquet(path)
    current = group_refine(fingerprinted(base)).where(number % 29 != 0).withColumn("UPDATE", F.lit(2))
    before = base.where((number % 19 != 0) & (number % 23 != 1))
    before = before.withColumn("G_NAME", F.when(number % 17 == 0, "renamed").otherwise(F.col("G_NAME")))
    return snapshot_union(current, group_refine(fingerprinted(before)).withColumn("UPDATE", F.lit(1)))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit sign hashes of embeddings, and planted near copies."""
    bits = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    base = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.lpad(F.lower(F.conv(bits, 2, 16)), 16, "0").alias("h"))
    tail = base.where("id % 2 = 0").select((F.col("id") + 1_000_000).alias("id"), F.concat(F.substring("h", 1, 15), F.lit("0")).alias("h"))
    middle = base.where("id % 3 = 0").select((F.col("id") + 2_000_000).alias("id"), F.concat(F.substring("h", 1, 6), F.lit("f"), F.substring("h", 8, 9)).alias("h"))
    return base.unionByName(tail).unionByName(middle).select(F.col("id").cast("string").alias("G_NO"), F.col("h").alias("IMG_HASH_V2"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.concat_ws("\t", "source", F.col("doc_id").cast("string")).alias("value"))


def tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fields, the last of which is empty for every seventh order."""
    last = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select(F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority", last).alias("value"))
