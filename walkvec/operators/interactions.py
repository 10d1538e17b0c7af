"""From an interaction log to each member's selected items and their shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walkvec.operators.skew import anti_join_hot

# Shares are kept in units of 1e-5 as integers: products and sums of them are
# exact and so do not depend on the order of summation.
SHARE_UNIT = 100_000


def clean(log: DataFrame, rating_min: float) -> DataFrame:
    """Best rating per (member, item) of the vip rows with an item, if high enough."""
    return (
        log.where((F.col("vip") == 1) & (F.length("item_id") > 0) & (F.col("rating") >= rating_min))
        .groupBy("member_id", "item_id")
        .agg(F.max("rating").alias("rating"))
        # True by the filter above. It keeps the rating in the plan of callers
        # that only count, so that they share this aggregation's shuffle.
        .where(F.col("rating") >= rating_min)
    )


def item_users(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("item_id").agg(F.count("*").alias("users"))


def hot_items(cleaned: DataFrame, cap: int) -> DataFrame:
    """Items with more than ``cap`` users."""
    return item_users(cleaned).where(F.col("users") > cap)


def drop_hot_items(cleaned: DataFrame, cap: int) -> DataFrame:
    return anti_join_hot(cleaned, hot_items(cleaned, cap), "item_id", "member_id")


def select_items(cleaned: DataFrame, per_member: int | None) -> DataFrame:
    """Top items per member by squared rating (None: all), with their share of its weight.

    The row_number filter is also applied before the shuffle by member, so a
    member with very many items sends only ``per_member`` rows per task.
    """
    by_weight = Window.partitionBy("member_id").orderBy(F.desc("w"), "item_id")
    whole = Window.partitionBy("member_id")
    share = F.floor(F.col("w") / F.sum("w").over(whole) * SHARE_UNIT + F.lit(0.5)).cast("bigint")
    weighted = cleaned.select("member_id", "item_id", F.pow("rating", F.lit(2.0)).alias("w"))
    if per_member is not None:
        weighted = weighted.withColumn("rn", F.row_number().over(by_weight)).where(F.col("rn") <= per_member)
    return (
        weighted.withColumn("share_units", share)
        .select(
            "member_id",
            "item_id",
            (F.col("share_units") / F.lit(float(SHARE_UNIT))).alias("share"),
        )
    )


def share_units(share: str = "share"):
    """The integer behind a published share."""
    return F.round(F.col(share) * SHARE_UNIT).cast("bigint")


def member_history(selected: DataFrame) -> DataFrame:
    """Number of selected items per member."""
    return selected.groupBy("member_id").agg(F.count("*").alias("his_length"))


def symmetric_item_pairs(rows: DataFrame, value: str) -> DataFrame:
    """Both orders of every two items of a member, with the product of their values.

    Expects the rows of :func:`select_items`, which bounds the items of a member.
    """
    a = rows.select("member_id", F.col("item_id").alias("item_a"), F.col(value).alias("_va"))
    b = rows.select("member_id", F.col("item_id").alias("item_b"), F.col(value).alias("_vb"))
    return (
        a.join(b, "member_id")
        .where(F.col("item_a") != F.col("item_b"))
        .select("member_id", "item_a", "item_b", (F.col("_va") * F.col("_vb")).alias("weight"))
    )
