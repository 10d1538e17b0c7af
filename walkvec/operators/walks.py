"""Random walks on the pruned member graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.functions.scalar import let, uniform
from walkvec.operators.graph import adjacency
from walkvec.stage import stage

STRATEGIES = ("weighted", "greedy", "uniform")
DEAD_ENDS = ("renormalize", "leak")
SENTINEL = -1


def next_node(strategy: str, dead_end: str, u: Column) -> Column:
    """The next node from the joined adjacency row, or null at a dead end.

    weighted  first neighbour, in ascending order, whose running weight exceeds the draw
    greedy    heaviest neighbour, ties to the larger id
    uniform   any neighbour with equal chance
    ``leak`` draws on the full degree, so weight cut away by pruning ends the
    walk; ``renormalize`` draws on the kept weight only.
    """
    nbrs = F.col("nbrs")
    total = F.col("kept_units") if dead_end == "renormalize" else F.col("degree_units")
    if strategy == "weighted":
        return let(
            u * total, lambda draw: F.get(F.filter(nbrs, lambda n: draw < n["cum"]), 0)["dst"]
        )
    chosen = (
        F.element_at(nbrs, -1)["dst"]
        if strategy == "greedy"
        else F.get(nbrs, F.floor(u * F.size(nbrs)).cast("int"))["dst"]
    )
    if dead_end == "renormalize":
        return chosen
    return F.when(u * total < F.col("kept_units"), chosen)


def random_walks(
    trans: DataFrame,
    steps: int,
    walks_per_node: int,
    strategy: str = "weighted",
    dead_end: str = "renormalize",
    seed: int = 42,
    keep_sentinel: bool = False,
    stage_every: int = 5,
) -> DataFrame:
    """``walks_per_node`` walks of ``steps`` steps from every node: (seg_id, walk_id, nodes).

    The adjacency is written once. Each step joins the walks, by current node,
    to it: its shuffle is the same sub-plan in every step and is reused, while
    adaptive execution splits a partition in which many walks meet at one hub.
    The first step starts on the adjacency rows and needs no join. A walk at a
    dead end before the last step is dropped; at the last step it keeps its
    nodes, with -1 appended only if ``keep_sentinel``.
    """
    if strategy not in STRATEGIES or dead_end not in DEAD_ENDS:
        raise ValueError(f"strategy is one of {STRATEGIES}, dead_end one of {DEAD_ENDS}")
    each = F.explode(F.sequence(F.lit(1), F.lit(walks_per_node)))
    # Nothing is drawn then: the walks of a node are one, and a node needs its heaviest neighbour only.
    fixed = strategy == "greedy" and dead_end == "renormalize"
    if fixed:
        heaviest = F.max(F.struct("units", "dst"))["dst"].alias("heaviest")
        adj = stage(trans.groupBy("seg_id", F.col("src").alias("node_id")).agg(heaviest), "adjacency")
        walks = adj.withColumn("walk_id", F.concat_ws("|", "seg_id", "node_id"))
    else:
        adj = stage(adjacency(trans, "dst" if strategy == "uniform" else "units"), "adjacency")
        walks = adj.withColumn("k", each).withColumn("walk_id", F.concat_ws("|", "seg_id", "node_id", "k"))
    walks = walks.withColumn("nodes", F.array("node_id"))
    for step in range(1, steps + 1):
        if step > 1:
            walks = walks.join(
                adj.withColumnRenamed("node_id", "cur"), ["seg_id", "cur"]
            )
        u = uniform(seed, F.col("walk_id"), step)
        drawn = F.array(F.col("heaviest") if fixed else next_node(strategy, dead_end, u))
        # Exploding the one-element array drops dead walks, and keeps the optimizer
        # from computing the draw a second time as a join condition.
        drawn = F.array_compact(drawn) if step < steps else drawn
        walks = walks.select("seg_id", "walk_id", "nodes", F.explode(drawn).alias("cur"))
        last = F.coalesce("cur", F.lit(SENTINEL)) if keep_sentinel else F.col("cur")
        walks = walks.withColumn("nodes", F.array_compact(F.concat("nodes", F.array(last))))
        if step % stage_every == 0 and step < steps:
            walks = stage(walks, "walks")
    if fixed:
        walks = walks.withColumn("k", each).withColumn("walk_id", F.concat_ws("|", "walk_id", "k"))
    return walks.select("seg_id", "walk_id", "nodes")


def single_walks(trans: DataFrame, length: int, **options) -> DataFrame:
    """One walk of ``length`` nodes from every node."""
    return random_walks(trans, length - 1, 1, **options)


def visit_histogram(walks: DataFrame) -> DataFrame:
    """How many vertices are visited how often."""
    visits = (
        walks.select("seg_id", F.explode("nodes").alias("node_id"))
        .groupBy("seg_id", "node_id")
        .agg(F.count("*").alias("visits"))
    )
    return visits.groupBy("visits").agg(F.count("*").alias("vertices"))
