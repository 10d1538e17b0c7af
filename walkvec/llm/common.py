"""What several operators of this subpackage use."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walkvec.stage import stage

#: A word is a longest run without a space or a control character from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column | str) -> Column:
    """Number of words of a text; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(*columns: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns' values alone."""
    bits = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30))
    return bits / F.lit(float(1 << 30))


#: Whole texts and sets travel to Python so many rows at a time: both sides hold a batch per task.
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Batches of at most ``rows`` rows for the Python steps that run inside; the session's own size after that."""
    before = spark.conf.get(_BATCH_CONF)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(_BATCH_CONF, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows; at the end, memory that Arrow keeps in the worker is given back."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    pa.default_memory_pool().release_unused()


def free_prefix(df: DataFrame) -> str:
    """A prefix that none of the columns begins with, for columns added beside them."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph (a, b), a != b, as (node, root).

    ``root`` is the least node of the component. Large-star and small-star steps
    take turns until nothing changes, which takes a number of rounds that grows
    with the logarithm of the graph's size, not with its diameter. A round only
    groups by node with partial aggregation and looks minima up; no group is
    collected. Each round is staged, so lineage stays short.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        # e: every edge as (a, b); the neighbours of a move to the least of a and its neighbours.
        near = both(e) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = near.join(least, "a")
        out = moved.where(F.col("b") > F.col("a")) if large else moved
        linked = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            linked = linked.unionByName(least.select("a", F.col("m").alias("b")))
        return linked.where(F.col("a") != F.col("b")).distinct()

    def digest(e: DataFrame):
        return e.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).cast("string")
        ).first()

    edges = stage(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    before = None
    while True:
        edges = stage(star(star(edges, True), False), "stars")
        now = digest(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
