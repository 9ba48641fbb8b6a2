"""Which listings take part in grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import NULL_TEXT


def active_ads(ads: DataFrame) -> DataFrame:
    """Ads that run: status r and a coin other than 0; an unknown coin is another."""
    return ads.where((F.lower("B_STATUS") == "r") & (F.coalesce("B_COIN", F.lit(NULL_TEXT)) != "0"))


def eligible_listings(goods: DataFrame) -> DataFrame:
    """Listings without ad priority that are neither closed nor deleted."""
    return goods.where(
        F.coalesce("G_PRIORITY_ORDER", F.lit("")).isin("", "0")
        & (F.coalesce("G_CLOSE_DATE", F.lit("")) == "")
        & (F.lower(F.coalesce("IS_DELETE", F.lit("N"))) != "y")
    )


def excluded_sellers(sellers: DataFrame) -> DataFrame:
    """Sellers that opted in to ads."""
    return sellers.where(F.lower("APPLY_STATUS") == "a").select("CTRL_ROWID").where(F.col("CTRL_ROWID").isNotNull()).distinct()


def without_sellers(rows: DataFrame, sellers: DataFrame) -> DataFrame:
    """Rows of known sellers that aren't among ``sellers``. Spark broadcasts the
    sellers where they are measured to be few, and shuffles both sides otherwise."""
    known = rows.where(F.col("CTRL_ROWID").isNotNull() & (F.col("CTRL_ROWID") != NULL_TEXT))
    return known.join(sellers, "CTRL_ROWID", "left_anti")


def greatest_ranks(ranks: DataFrame) -> DataFrame:
    """(G_NO, RANK): each listing's greatest rank."""
    order = F.struct(F.expr("try_cast(RANK as double)").alias("number"), F.col("RANK").alias("text"))
    return ranks.groupBy("G_NO").agg(F.max(F.when(F.col("RANK").isNotNull(), order)).alias("__rank")).select("G_NO", F.col("__rank.text").alias("RANK"))


def eligible_goods(goods: DataFrame, ads: DataFrame, ranks: DataFrame, sellers: DataFrame) -> DataFrame:
    """Eligible listings of other sellers, with their rank, unless an ad runs for
    them. Sellers are tested on each input by itself, before anything is joined: an
    ad of an excluded seller excludes no listing. Of several ranks of a listing the
    greatest number counts; text that is no number is less than any."""
    out = excluded_sellers(sellers)
    kept = without_sellers(eligible_listings(goods), out)
    running = without_sellers(active_ads(ads), out).select("G_NO").distinct()
    ranked = greatest_ranks(without_sellers(ranks, out))
    return kept.join(running, "G_NO", "left_anti").join(ranked, "G_NO", "left")
