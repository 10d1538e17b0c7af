"""Vocabularies of item side features and the encoding of items with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.operators.dense_index import dense_index
from walkvec.operators.skew import lookup
from walkvec.stage import stage

# The side columns in file order; the last one is multi-valued.
SINGLE = ("gds", "gen_gds", "l4", "l3", "l2", "big_brand", "shop")
MULTI = "sal"
FEATURES = (*SINGLE, MULTI)
# The order in which an item's feature vectors meet their weights.
SLOTS = ("gds", "gen_gds", "shop", "l4", "l3", "l2", "big_brand", "sal")
# Features an item outside the training data may lack.
OPTIONAL = ("gds", "gen_gds")

# What an item row is published by. Rows may be equal in it: each stays an item of its own.
KEY = ("node", "gds", "shop")


def item_key():
    """Published item name."""
    return F.concat_ws("_", "gds", "shop")


def feature_values(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per item, feature and value: (k_<keep>…, feature, ord, value)."""
    single = [
        F.struct(F.lit(f).alias("feature"), F.lit(0).alias("ord"), F.col(f).alias("value"))
        for f in SINGLE
    ]
    multi = F.transform(
        MULTI,
        lambda v, i: F.struct(F.lit(MULTI).alias("feature"), i.alias("ord"), v.alias("value")),
    )
    return items.select(
        *[F.col(k).alias(f"k_{k}") for k in keep],
        F.explode(F.concat(F.array(*single), multi)).alias("f"),
    ).select(*[f"k_{k}" for k in keep], "f.*")


def build_vocabulary(items: DataFrame) -> DataFrame:
    """(feature, value, idx): each feature's distinct values numbered in value order."""
    distinct = feature_values(items).select("feature", "value").where("value IS NOT NULL").distinct()
    return dense_index(distinct, ["feature"], ["value"], "idx")


def cardinalities(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.groupBy("feature").agg(F.count("*").alias("size"))


def _encoded(items: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row per item with an index per feature (null where unknown), the known
    values of the multi-valued feature in order, and how many of its values there are."""
    numbered = stage(items.withColumn("row", F.monotonically_increasing_id()), "items")
    long = stage(feature_values(numbered, ("row", *KEY)), "values")
    found = lookup(long, vocabulary, ["feature", "value"], spread="k_row")
    single = [F.max(F.when(F.col("feature") == f, F.col("idx"))).alias(f"{f}_idx") for f in SINGLE]
    known = F.when((F.col("feature") == MULTI) & F.col("idx").isNotNull(), F.struct("ord", "idx"))
    # An item's own list of values: bounded by the input row it came from.
    listed = F.transform(F.array_sort(F.collect_list(known)), lambda s: s["idx"])
    return found.groupBy("k_row", *[f"k_{k}" for k in KEY]).agg(
        *single,
        listed.alias("sal_idx"),
        F.count(F.when(F.col("feature") == MULTI, F.lit(1))).alias("_sal_values"),
    ).select(
        *[F.col(f"k_{k}").alias("node" if k == "node" else f"item_{k}") for k in KEY],
        *[f"{f}_idx" for f in SINGLE],
        "sal_idx",
        "_sal_values",
    )


def _named(encoded: DataFrame) -> DataFrame:
    name = F.concat_ws("_", "item_gds", "item_shop").alias("item_key")
    return encoded.select("node", name, *[f"{f}_idx" for f in SINGLE], "sal_idx")


def _all_known():
    ok = F.size("sal_idx") == F.col("_sal_values")
    for f in SINGLE:
        ok = ok & F.col(f"{f}_idx").isNotNull()
    return ok


def encode(items: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Items whose every value is known; see :func:`encode_rejects` for the others."""
    return _named(_encoded(items, vocabulary).where(_all_known()))


def encode_rejects(items: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Items with a value outside the vocabulary."""
    return _named(_encoded(items, vocabulary).where(~_all_known()))


def encode_cold(
    items: DataFrame, vocabulary: DataFrame, node_count: Column | int, index0_is_oov: bool = False
) -> DataFrame:
    """Items outside the training data, if enough of their features are known.

    Required: l4, l3, l2, brand, shop, and one or more known sal values. An
    unknown gds or gen_gds, and a node outside [0, node_count), become null.
    ``index0_is_oov`` treats the first value of each feature as unknown.
    """
    if index0_is_oov:
        vocabulary = vocabulary.where("idx > 0")
    encoded = _encoded(items, vocabulary)
    admitted = F.size("sal_idx") > 0
    for f in SINGLE:
        if f not in OPTIONAL:
            admitted = admitted & F.col(f"{f}_idx").isNotNull()
    node = F.when(F.col("node").between(0, node_count - 1), F.col("node"))
    return _named(encoded.where(admitted).withColumn("node", node))
