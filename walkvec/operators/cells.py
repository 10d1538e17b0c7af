"""Split the pairs of each group into cells of bounded size.

A group of n rows is cut into ceil(n / block_rows) blocks by a hash of the row
id, and each unordered pair of blocks is a cell (b1 <= b2). Two rows meet in
exactly one cell, no cell holds more than about 2 * block_rows rows, and a row
is copied once per block of its group. So a group of any size is spread evenly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkvec.operators.skew import salt_of, with_salts

BLOCK_ROWS = 2_048


def with_blocks(
    df: DataFrame, group: Sequence[str], row_id: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``_blocks`` (of the group) and ``_block`` (of the row)."""
    group = list(group)
    # Only groups above one block are listed: at most rows / block_rows.
    large = (
        df.groupBy(*group)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > block_rows)
        .select(*group, F.ceil(F.col("_n") / block_rows).cast("int").alias("_large"))
    )
    salted = df.withColumn("_salt", salt_of(row_id)).join(
        with_salts(large), [*group, "_salt"], "left"
    )
    blocks = F.coalesce("_large", F.lit(1))
    block = F.pmod(F.xxhash64(F.lit("block"), row_id), blocks).cast("int")
    return salted.withColumn("_blocks", blocks).withColumn("_block", block).drop("_salt", "_large")


def first_side(blocked: DataFrame) -> DataFrame:
    """Rows as the b1 side of their cells."""
    return blocked.select(
        "*",
        F.col("_block").alias("_b1"),
        F.explode(F.sequence(F.col("_block"), F.col("_blocks") - 1)).alias("_b2"),
    ).drop("_block", "_blocks")


def second_side(blocked: DataFrame) -> DataFrame:
    """Rows as the b2 side of their cells."""
    return blocked.select(
        "*",
        F.explode(F.sequence(F.lit(0), F.col("_block"))).alias("_b1"),
        F.col("_block").alias("_b2"),
    ).drop("_block", "_blocks")


def cell_members(blocked: DataFrame) -> DataFrame:
    """Each row once per cell it belongs to, for functions that see whole cells."""
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        blocked.withColumn("_other", other)
        .withColumn("_b1", F.least("_block", "_other"))
        .withColumn("_b2", F.greatest("_block", "_other"))
        .drop("_other", "_blocks")
    )


def join_pairs(
    df: DataFrame,
    group: Sequence[str],
    row_id: str,
    values: Sequence[str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each unordered pair of rows of a group once.

    Columns: the group, ``lo`` and ``hi`` (row ids, lo < hi) and for every value
    column v the pair ``v_lo`` and ``v_hi``.
    """
    group = list(group)
    blocked = with_blocks(df.select(*group, row_id, *values), group, row_id, block_rows)
    left = first_side(blocked).select(
        *group, "_b1", "_b2", F.col(row_id).alias("_lid"), *[F.col(v).alias(f"_l_{v}") for v in values]
    )
    right = second_side(blocked).select(
        *group, "_b1", "_b2", F.col(row_id).alias("_rid"), *[F.col(v).alias(f"_r_{v}") for v in values]
    )
    ordered = F.col("_lid") < F.col("_rid")
    joined = left.join(right, [*group, "_b1", "_b2"]).where((F.col("_b1") < F.col("_b2")) | ordered)

    def pick(a: str, b: str, name: str):
        return F.when(ordered, F.col(a)).otherwise(F.col(b)).alias(name)

    sides = [
        c
        for v in values
        for c in (pick(f"_l_{v}", f"_r_{v}", f"{v}_lo"), pick(f"_r_{v}", f"_l_{v}", f"{v}_hi"))
    ]
    return joined.select(*group, pick("_lid", "_rid", "lo"), pick("_rid", "_lid", "hi"), *sides)
