"""Member graph: edges, degrees, transitions, adjacency.

Weights are integers in units of 1e-10 (the product of two 1e-5 shares) in the
column ``units``; every sum is exact. All segments are processed in one plan,
with ``seg_id`` as part of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walkvec.operators.cells import BLOCK_ROWS, join_pairs
from walkvec.operators.interactions import SHARE_UNIT, share_units
from walkvec.operators.skew import lookup
from walkvec.stage import stage

WEIGHT_UNIT = SHARE_UNIT * SHARE_UNIT


def node_records(selected: DataFrame, nodes: DataFrame) -> DataFrame:
    """Selected records by node: (seg_id, item_id, node_id, share_units)."""
    return (
        selected.select("member_id", "item_id", share_units().alias("share_units"))
        .join(nodes, "member_id")
        .select("seg_id", "item_id", "node_id", "share_units")
    )


def drop_items_of_size(records: DataFrame, size: int | None) -> DataFrame:
    """Leave out (segment, item) groups of exactly ``size`` users."""
    if size is None:
        return records
    exact = records.groupBy("seg_id", "item_id").agg(F.count("*").alias("_n"))
    found = lookup(records, exact, ["seg_id", "item_id"], spread="node_id", counts=exact.withColumnRenamed("_n", "_rows"))
    return found.where(F.col("_n") != size).drop("_n")


def member_edges(records: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Undirected edges (seg_id, lo, hi, units): sum over items of share products."""
    pairs = join_pairs(records, ["seg_id", "item_id"], "node_id", ["share_units"], block_rows)
    product = F.col("share_units_lo") * F.col("share_units_hi")
    return pairs.groupBy("seg_id", "lo", "hi").agg(F.sum(product).alias("units"))


def both_directions(edges: DataFrame) -> DataFrame:
    """(seg_id, src, dst, units) in both directions from one pass over the edges."""
    ends = F.array(
        F.struct(F.col("lo").alias("src"), F.col("hi").alias("dst")),
        F.struct(F.col("hi").alias("src"), F.col("lo").alias("dst")),
    )
    return edges.select("seg_id", F.explode(ends).alias("e"), "units").select(
        "seg_id", "e.src", "e.dst", "units"
    )


def published_weight():
    return F.col("units") / F.lit(float(WEIGHT_UNIT))


def weighted_degree(directed: DataFrame) -> DataFrame:
    """Sum of weights per source node, from an edge list."""
    return directed.groupBy("seg_id", F.col("src").alias("node_id")).agg(
        F.sum("units").alias("degree_units")
    )


def weighted_degree_of_records(records: DataFrame) -> DataFrame:
    """The same degrees straight from the records, in time linear in them.

    With S the sum of an item's shares, a member's share s meets S - s on that
    item, so its degree is the sum of s * (S - s) and no pair is formed.
    Members that share no item with anybody have no row, as in an edge list.
    """
    totals = records.groupBy("seg_id", "item_id").agg(
        F.sum("share_units").alias("_total"), F.count("*").alias("_users")
    )
    totals = stage(totals.where("_users > 1"), "totals")
    met = F.col("share_units") * (F.col("_total") - F.col("share_units"))
    keys = ["seg_id", "item_id"]
    counts = totals.select(*keys, F.col("_users").alias("_rows"))
    found = lookup(records, totals.drop("_users"), keys, spread="node_id", how="inner", counts=counts)
    return found.groupBy("seg_id", "node_id").agg(F.sum(met).alias("degree_units"))


def transitions(
    directed: DataFrame, neighbours: int | None, degree: DataFrame | None = None
) -> DataFrame:
    """The strongest neighbours per node (None: all) with their probability.

    The probability is weight / full weighted degree, so a cut row sums to less
    than 1. The cut is also applied before the shuffle by source.
    """
    degree = weighted_degree(directed) if degree is None else degree
    strongest = Window.partitionBy("seg_id", "src").orderBy(F.desc("units"), "dst")
    if neighbours is not None:
        ranked = directed.withColumn("_rn", F.row_number().over(strongest))
        directed = ranked.where(F.col("_rn") <= neighbours).drop("_rn")
    degrees = degree.withColumnRenamed("node_id", "src")
    return directed.join(degrees, ["seg_id", "src"]).withColumn(
        "prob", F.col("units") / F.col("degree_units")
    )


def adjacency(trans: DataFrame, order: str = "units") -> DataFrame:
    """One row per node with its neighbours as an array (bounded by the cut).

    ``order="units"`` sorts by (weight, dst) and ``order="dst"`` by dst; ``cum``
    is the running sum of weights in that order and ``kept_units`` its last value.
    """
    keys = ["units", "dst"] if order == "units" else ["dst"]
    running = (
        Window.partitionBy("seg_id", "src")
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    place = F.row_number().over(Window.partitionBy("seg_id", "src").orderBy(*keys))
    return (
        trans.withColumn("cum", F.sum("units").over(running))
        .withColumn("place", place)
        .groupBy("seg_id", F.col("src").alias("node_id"))
        .agg(
            F.max("degree_units").alias("degree_units"),
            F.max("cum").alias("kept_units"),
            F.array_sort(F.collect_list(F.struct("place", "cum", "dst"))).alias("nbrs"),
        )
    )


def edges_from_list(edge_list: DataFrame) -> DataFrame:
    """Directed edges from (src, dst, weight) rows, each added in both directions.

    Without a ``seg_id`` column all of them belong to segment 0.
    """
    seg_id = F.col("seg_id") if "seg_id" in edge_list.columns else F.lit(0).alias("seg_id")
    units = F.round(F.col("weight") * WEIGHT_UNIT).cast("bigint").alias("units")
    ends = F.col("src").alias("lo"), F.col("dst").alias("hi")
    return both_directions(edge_list.select(seg_id, *ends, units))
