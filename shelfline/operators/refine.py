"""Sizes and heads of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_refine(rows: DataFrame) -> DataFrame:
    """Adds GROUP_NUM and GROUP_HEAD to fingerprinted listings.

    The size counts all rows of a group; rows without a post time are then left
    out. The head has the greatest rank, then post time, then number, then number as
    text, so that two listings are never both heads; rows of one listing that are
    equal in all of these are marked alike. An unknown rank is the least. Size and head are partial aggregates joined back: a group
    that a third of all listings belong to is never sorted by one task.
    """
    order = F.struct(F.expr("try_cast(RANK as double)").alias("r"), F.col("G_POST_TIME").alias("t"), F.expr("try_cast(G_NO as decimal(38,0))").alias("g"), F.col("G_NO").alias("x"))
    rows = rows.drop("GROUP_NUM", "GROUP_HEAD").withColumn("__o", F.when(F.col("G_POST_TIME").isNotNull(), order))
    groups = rows.groupBy("FINGERPRINT").agg(F.count(F.lit(1)).alias("GROUP_NUM"), F.max("__o").alias("__head"))
    joined = rows.join(groups, "FINGERPRINT").where(F.col("G_POST_TIME").isNotNull())
    head = F.when(F.col("__o").eqNullSafe(F.col("__head")), "Y").otherwise("N")
    return joined.withColumn("GROUP_HEAD", head).drop("__o", "__head")


def group_heads(refined: DataFrame) -> DataFrame:
    return refined.where("GROUP_HEAD = 'Y'")
