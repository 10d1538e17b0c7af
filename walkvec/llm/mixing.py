"""Mix sources to target weights by entropy balancing.

Every document gets a rate, the number of times the mix takes it in the mean. Of
all rates that bring each source to its target of words, the chosen ones are
closest to 1 in relative entropy, on the open interval from 0 to ``cap``. The
solution is an exponential tilt of the document's words: odds(rate) grow by
exp(lambda * words), with one multiplier per source, the variable of the convex
dual. Newton's method finds the multipliers with one distributed aggregation per
iteration; it runs on the counts of (source, words), since a rate depends on
nothing else. Only DataFrame operations are used.

Rates become whole copies by floor(rate + u), u a hash of the row. What is then
missing from (or too much for) a source's target is made up from cells of its rows,
by size class and hash: the largest cell that fits gets one copy more (or fewer), then
the next, so that the rest is below the smallest cell that could still be changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.llm.common import free_prefix, n_words, uniform
from walkvec.operators.dense_index import dense_index
from walkvec.stage import stage

WEIGHTS = (1, 2, 3)
CAP = 3
ITERATIONS = 60
TOLERANCE = 1e-4
BINS = 64


def source_targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, total: float | None = None
) -> DataFrame:
    """(source, sid, source_size, target): ``total`` words (default: all) shared by weight.

    Weights repeat over the sources in code-point order, null last. A target stops
    at ``cap`` times its source's words; the excess is shared again by weight until
    no target is above. With no words at all every target is 0.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = dense_index(
        sizes.withColumn("last", F.col("source").isNull()), [], ["last", "source"], "nth"
    )
    values = F.array(*[F.lit(float(w)) for w in weights])
    rows = stage(
        ordered.select(
            "source",
            F.col("nth").alias("sid"),
            "source_size",
            values[F.pmod("nth", F.lit(len(weights))).cast("int")].alias("weight"),
            (F.lit(float(cap)) * F.col("source_size")).alias("most"),
        ),
        "targets",
    )
    whole, free = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    whole = float(total if total is not None else whole or 0)
    level, stopped = (whole / free if free else 0.0), -1
    while True:
        above = F.col("most") <= F.col("weight") * F.lit(level)
        n, taken, weight = rows.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, F.col("most"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == stopped or not weight:
            break
        stopped, level = n, max(0.0, (whole - (taken or 0.0)) / weight)
    target = F.least("most", F.col("weight") * F.lit(level))
    return rows.select("source", "sid", "source_size", target.alias("target"))


def _tilted(multiplier: Column, size: Column, cap: int) -> Column:
    """The rate in (0, cap) whose odds against the cap are tilted; 1 at multiplier 0."""
    return F.lit(float(cap)) / (1 + F.lit(float(cap - 1)) * F.exp(-F.least(F.lit(500.0), F.greatest(F.lit(-500.0), multiplier * size))))


def tilt(sized: DataFrame, targets: DataFrame, cap: int = CAP, iterations: int = ITERATIONS) -> DataFrame:
    """(sid, multiplier, full): the dual solution for ``targets`` (sid, source_size, target).

    ``sized`` has sid and size. ``full`` marks a source whose target is cap times its
    words (rate = cap; no finite multiplier gives it). The words of a source rise with
    its multiplier, so Newton steps on their logarithm are kept inside a bracket and
    replaced by halving where they leave it. Sources without words are left out.
    """
    spread = stage(
        sized.where("size > 0").groupBy("sid", "size").agg(F.count("*").cast("double").alias("n")), "sizes"
    )
    means = spread.groupBy("sid").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    full = F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-9))
    state = stage(
        targets.join(means, "sid").select(
            "sid",
            "target",
            "mean",
            full.alias("full"),
            F.lit(0.0).alias("x"),  # multiplier times the mean size
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            (full | (F.col("target") <= 0)).alias("done"),
        ),
        "dual",
    )
    rate = _tilted(F.col("x") / F.col("mean"), F.col("size"), cap)
    slope = rate * (1 - rate / F.lit(float(cap))) * F.col("size") / F.col("mean")
    gap = F.log(F.col("words") / F.col("target"))
    step = F.col("x") - gap * F.col("words") / F.col("grows")
    inside = (step > F.coalesce("low", F.lit(-1e18))) & (step < F.coalesce("high", F.lit(1e18)))
    wider = (
        F.when(F.col("low").isNull(), 2 * F.least("high", F.lit(-0.5)))
        .when(F.col("high").isNull(), 2 * F.greatest("low", F.lit(0.5)))
        .otherwise((F.col("low") + F.col("high")) / 2)
    )
    for _ in range(iterations):
        sums = (
            spread.join(state.where("not done").select("sid", "x", "mean"), "sid")
            .groupBy("sid")
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("words"),
                F.sum(F.col("n") * F.col("size") * slope).alias("grows"),
            )
        )
        settled = F.col("words").isNull() | (F.abs(gap) < TOLERANCE)
        state = stage(
            state.join(sums, "sid", "left")
            .withColumn("low", F.when(gap <= 0, F.col("x")).otherwise(F.col("low")))
            .withColumn("high", F.when(gap > 0, F.col("x")).otherwise(F.col("high")))
            .select(
                "sid",
                "target",
                "mean",
                "full",
                F.when(settled, F.col("x")).when(inside & ~F.isnan(step), step).otherwise(wider).alias("x"),
                "low",
                "high",
                settled.alias("done"),
            ),
            "dual",
        )
        if state.where("not done").isEmpty():
            break
    # Rounded, so that sums in another order of rows give the same copies.
    return state.select("sid", (F.round("x", 6) / F.col("mean")).alias("multiplier"), "full")


def mix(
    sized: DataFrame,
    row: Sequence[str],
    weights: Sequence[float] = WEIGHTS,
    cap: int = CAP,
    bins: int = BINS,
    seed: int = 0,
) -> DataFrame:
    """``sized`` (staged; source, size and more) with source_size, target, rate and copies.

    ``row`` names the columns whose hash is the row's share of chance. Rows that are
    equal in them get the same copies. Copies lie between 0 and ``cap``; a row
    without words has rate 1 (0 where the target is 0) and never changes a sum.
    """
    targets = stage(source_targets(sized, weights, cap), "targets")
    ids = targets.select(F.col("source").alias("_source"), "sid", "source_size", "target")
    numbered = sized.join(ids, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    dual = tilt(numbered, targets, cap)
    rate = (
        F.when(F.col("target") <= 0, F.lit(0.0))
        .when(F.col("full"), F.lit(float(cap)))
        .otherwise(_tilted(F.coalesce("multiplier", F.lit(0.0)), F.col("size"), cap))
    )
    rated = numbered.join(dual, "sid", "left").withColumn("rate", rate)
    based = (
        rated.withColumn("base", F.least(F.floor(F.col("rate") + uniform(*row, seed=seed)), F.lit(cap)))
        .withColumn("class", F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int"))
        .withColumn("bin", F.pmod(F.xxhash64(F.lit(seed + 1), *row), F.lit(bins)).cast("int"))
    )

    # Cells of rows whose copies can change; at most classes x bins of them per source.
    free = (F.col("target") > 0) & ~F.coalesce("full", F.lit(False))
    zero = F.lit(0).cast("bigint")
    cells = stage(
        based.groupBy("sid", "target", "class", "bin").agg(
            F.sum(F.col("base") * F.col("size")).alias("taken"),
            F.sum(F.when(free & (F.col("base") < cap), F.col("size")).otherwise(zero)).alias("more"),
            F.sum(F.when(free & (F.col("base") >= 1), F.col("size")).otherwise(zero)).alias("fewer"),
        ),
        "cells",
    )
    gaps = cells.groupBy("sid").agg((F.first("target") - F.sum("taken")).alias("gap"))
    fitting = (
        cells.join(gaps, "sid")
        .withColumn("words", F.when(F.col("gap") > 0, F.col("more")).otherwise(F.col("fewer")))
        .where((F.col("words") > 0) & (F.col("words") <= F.abs("gap")))
        .groupBy("sid", "gap")
        .agg(F.sort_array(F.collect_list(F.struct("words", "class", "bin")), asc=False).alias("list"))
    )
    chosen = F.aggregate(
        "list",
        F.struct(F.abs("gap").alias("left"), F.array().cast("array<struct<class:int,bin:int>>").alias("cells")),
        lambda acc, cell: F.when(
            cell["words"] <= acc["left"],
            F.struct(
                (acc["left"] - cell["words"]).alias("left"),
                F.concat(acc["cells"], F.array(F.struct(cell["class"].alias("class"), cell["bin"].alias("bin")))).alias("cells"),
            ),
        ).otherwise(acc),
    )["cells"]
    moved = fitting.select("sid", F.signum("gap").cast("bigint").alias("move"), F.explode(chosen).alias("c"))
    moved = stage(moved.select("sid", "c.class", "c.bin", "move"), "moved")
    fits = F.when(F.col("move") > 0, F.col("base") < cap).otherwise(F.col("base") >= 1)
    copies = F.col("base") + F.when(F.col("move").isNotNull() & free & fits, F.col("move")).otherwise(zero)
    return (
        based.join(moved, ["sid", "class", "bin"], "left")
        .withColumn("copies", copies.cast("bigint"))
        .drop("sid", "multiplier", "full", "base", "class", "bin", "move")
    )


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words of the whole text; null text: 0), staged."""
    return stage(docs.select("doc_id", "source", n_words("text").alias("size")), "sized")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Every document with its size, its source's size and target, and the words the mix takes.

    Null texts have size 0; null sources are one source, last in the order. Repeated
    rows (equal doc_id and size) are taken equally often. An empty table gives no rows.
    Columns of ``docs`` other than doc_id, source and text play no part.
    """
    mixed = mix(sized_documents(docs), ["doc_id", "size"])
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        "rate",
        "source",
    )


def mixed_corpus(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; the columns stay."""
    wanted = mixed_documents(docs)
    # Copies follow from source, id and words; rows equal in them are taken equally often.
    wanted = wanted.groupBy("source", "doc_id", "size").agg(F.max("copies").alias("copies"))
    own = free_prefix(docs)
    wanted = stage(wanted.where("copies > 0"), "wanted").toDF(f"{own}source", f"{own}id", f"{own}size", f"{own}copies")
    same = (
        F.col("doc_id").eqNullSafe(F.col(f"{own}id"))
        & F.col("source").eqNullSafe(F.col(f"{own}source"))
        & (n_words("text") == F.col(f"{own}size"))
    )
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"{own}copies")))
    return docs.join(wanted, same).withColumn(f"{own}copy", copies).select(*docs.columns)
