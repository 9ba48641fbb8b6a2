"""What changed between two snapshots of groups, and the index documents for it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import same_text

FIELDS = ("G_NO", "FINGERPRINT", "GROUP_HEAD", "GROUP_NUM", "UPDATE")


def snapshot_union(current: DataFrame, old: DataFrame) -> DataFrame:
    return current.select(*FIELDS).withColumn("IS_OLD", F.lit("N")).unionByName(old.select(*FIELDS).withColumn("IS_OLD", F.lit("Y")))


def snapshot_top2(rows: DataFrame) -> DataFrame:
    """The two newest rows of each listing, numbered. Of equal times the current
    snapshot is newer, then the greater fingerprint. Spark limits each task's
    groups to two rows before the shuffle."""
    newest = Window.partitionBy("G_NO").orderBy(F.col("UPDATE").desc(), "IS_OLD", F.col("FINGERPRINT").desc(), "GROUP_HEAD", "GROUP_NUM")
    return rows.withColumn("rn", F.row_number().over(newest)).where("rn <= 2")


def group_delta(rows: DataFrame) -> DataFrame:
    """insert, update or delete for each listing whose group changed."""
    top = snapshot_top2(rows)
    fields = F.struct("FINGERPRINT", (F.col("GROUP_HEAD") == "Y").alias("HEAD"), "GROUP_NUM", "IS_OLD")
    pairs = top.groupBy("G_NO").agg(*[F.first(F.when(F.col("rn") == i, fields), ignorenulls=True).alias(name) for i, name in ((1, "cur"), (2, "last"))])
    cur, last = F.col("cur"), F.col("last")
    grouped, was_grouped = cur["GROUP_NUM"] > 1, last["GROUP_NUM"] > 1
    changed = ~same_text(cur["FINGERPRINT"], last["FINGERPRINT"]) | (cur["HEAD"] != last["HEAD"])
    single = F.when((cur["IS_OLD"] == "N") & grouped, "insert").when(cur["IS_OLD"] == "Y", "delete")
    both = F.when(grouped & was_grouped & changed, "update").when(grouped & ~was_grouped, "insert").when(~grouped & was_grouped, "delete")
    action = F.when(last.isNull(), single).otherwise(both)
    return pairs.withColumn("ACTION", action).where("ACTION IS NOT NULL").select("G_NO", "cur.FINGERPRINT", "cur.HEAD", "cur.GROUP_NUM", "cur.IS_OLD", "ACTION")


def index_update_docs(delta: DataFrame, batch_ts: datetime) -> DataFrame:
    """(G_NO, ACTION, doc): JSON of an atomic update, nulls written; a delete sets
    all three group fields to null."""

    def set_to(c: str) -> Column:
        return F.struct(F.when(F.col("ACTION") != "delete", F.col(c)).alias("set"))

    stamp = f"group_tag.{batch_ts:%Y%m%d%H%M%S}"
    when = f"{batch_ts:%Y-%m-%dT%H:%M:%S}Z"
    doc = F.struct(
        F.col("G_NO").alias("id"), set_to("FINGERPRINT").alias("GROUP_TAG"), set_to("HEAD").alias("GROUP_HEAD"), set_to("GROUP_NUM").alias("GROUP_NUM"),
        F.struct(F.lit(stamp).alias("add")).alias("_IMPORT"), F.struct(F.lit(when).alias("add")).alias("_SOURCE_TIME"),
    )
    return delta.select("G_NO", "ACTION", F.to_json(doc, {"ignoreNullFields": "false"}).alias("doc"))
