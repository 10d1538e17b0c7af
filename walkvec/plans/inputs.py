"""The inputs of the job, taken from the given parquet tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkvec.config import Config

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "-")
#: Popular enough here to show what the cut does; only hot_items and drop_hot_items use it.
FEWER_USERS = 28
CONFIG = replace(
    Config(),
    segment_labels=SEGMENTS,
    segment_aliases=(("HOUSEHOLD", "FURNITURE"),),
    lsh_threshold=1.2,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers rate parts by the quantity ordered; returned lines are not vip."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("member_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("l_quantity").alias("rating"),
        F.when(F.col("l_returnflag") != "R", 1).otherwise(0).alias("vip"),
    )


def member_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the market segment as age group; gender from the nation key."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("memb_id"),
        F.when(F.col("c_nationkey") % 3 == 0, "124000000020")
        .when(F.col("c_nationkey") % 3 == 1, "124000000010")
        .otherwise("unknown")
        .alias("gender_cd"),
        F.col("c_mktsegment").alias("age_group"),
    )


def purchase_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in the order in which each customer bought them."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("seq_id"),
        "o_orderdate",
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("token"),
    )


PURCHASE_ORDER = ("o_orderdate", "l_orderkey", "l_linenumber", "token")


def side_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items with their nine side columns."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("node"),
        F.col("p_partkey").cast("string").alias("gds"),
        F.regexp_replace("p_name", " ", "_").alias("gen_gds"),
        F.col("p_size").cast("string").alias("l4"),
        F.regexp_replace("p_type", " ", "_").alias("l3"),
        F.substring("p_type", 1, 1).alias("l2"),
        F.col("p_brand").alias("big_brand"),
        (F.col("p_partkey") % 10).cast("string").alias("shop"),
        F.split("p_name", " ").alias("sal"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("seg_id")
    )
