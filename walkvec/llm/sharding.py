"""Shards along a Hilbert curve through the documents' metadata.

Language, source and text size are quantised to 2^bits cells each, in order of
their values, and a document's cell is numbered along the Hilbert curve. Sorting by
that number and cutting the order into runs of equal length gives shards whose
minima and maxima in every dimension are narrow, so readers that filter by any of
them skip most files. Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.operators.dense_index import dense_index
from walkvec.stage import stage

SHARDS = 24
BITS = 5


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """Place of a cell (one integer column per dimension, below 2^bits) on the Hilbert curve.

    A fold over the bit planes keeps the coordinates in an array: first each plane's
    reflections and exchanges are undone, from the highest plane down, then the
    coordinates are Gray coded and their bits interleaved.
    """
    n = len(cells)
    zero = F.lit(0).cast("bigint")

    def set_two(x: Column, i: int, first: Column, other: Column) -> Column:
        return F.array(*[first if j == 0 else other if j == i else x[j] for j in range(n)])

    def bound(x: Column, i: int, step) -> Column:
        """step(x, i), with x named once: a one-element transform keeps expressions from doubling."""
        return F.transform(F.array(x), lambda y: step(y, i))[0]

    def undo(x: Column, plane: Column) -> Column:
        """One bit plane: for every dimension reflect or exchange the lower bits."""
        low = plane - 1

        def step(y: Column, i: int) -> Column:
            swap = y[0].bitwiseXOR(y[i]).bitwiseAND(low)
            exchanged = set_two(y, i, y[0].bitwiseXOR(swap), y[i].bitwiseXOR(swap))
            reflected = set_two(y, 0, y[0].bitwiseXOR(low), y[0])
            return F.when(y[i].bitwiseAND(plane) != 0, reflected).otherwise(exchanged)

        for i in range(n):
            x = bound(x, i, step)
        return x

    start = F.array(*[c.cast("bigint") for c in cells])
    planes = F.array(*[F.lit(1 << b).cast("bigint") for b in range(bits - 1, 0, -1)])
    x = F.aggregate(planes, start, undo) if bits > 1 else start

    def gray(y: Column) -> Column:
        out = [y[0]]
        for i in range(1, n):
            out.append(y[i].bitwiseXOR(out[-1]))
        return F.array(*out)

    def flip(y: Column) -> Column:
        t = zero
        for b in range(bits - 1, 0, -1):
            t = t.bitwiseXOR(
                F.when(y[n - 1].bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(zero)
            )
        return F.array(*[y[j].bitwiseXOR(t) for j in range(n)])

    def interleave(y: Column) -> Column:
        out = zero
        for b in range(bits):
            for j in range(n):
                bit = F.shiftright(y[j], b).bitwiseAND(F.lit(1).cast("bigint"))
                out = out + F.shiftleft(bit, b * n + (n - 1 - j))
        return out

    for f in (gray, flip, interleave):
        x = F.transform(F.array(x), f)[0]
    return x


def value_cells(rows: DataFrame, column: str, bits: int, name: str) -> DataFrame:
    """``rows`` with the cell of ``column``: its distinct values in order, null last, spread over 2^bits cells."""
    values = rows.select(F.col(column).alias("_value")).distinct().withColumn("_last", F.col("_value").isNull())
    ranked = stage(dense_index(values, [], ["_last", "_value"], "_nth"), "values")
    n = max(1, ranked.count())
    cells = ranked.select(
        "_value", F.floor(F.col("_nth") * F.lit(1 << bits) / F.lit(n)).cast("bigint").alias(name)
    )
    return rows.join(cells, F.col(column).eqNullSafe(F.col("_value"))).drop("_value")


def shard(rows: DataFrame, cells: Sequence[str], tie: Sequence[str], shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """``rows`` with curve, shard and slot: runs of equal row counts along the curve.

    Counts differ by one at most. ``tie`` orders rows of one cell; it must name a
    unique column last, fixed in a staged table, so that reruns of lost tasks agree.
    """
    curved = rows.withColumn("curve", hilbert_index([F.col(c) for c in cells], bits))
    ranked = dense_index(curved, [], ["curve", *tie], "_rank")
    n = max(1, rows.count())
    exact = F.expr(f"(_rank * {shards}L) div {n}L")
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return (
        ranked.withColumn("shard", exact)
        .withColumn("slot", F.col("_rank") - first)
        .withColumn("shard", F.col("shard").cast("int"))
        .drop("_rank")
    )


def described(docs: DataFrame) -> DataFrame:
    """The columns that sharding needs, one row per row of ``docs``, staged with a unique row number."""
    text = F.coalesce("text", F.lit(""))
    return stage(
        docs.select(
            "doc_id",
            "lang",
            "source",
            (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "described",
    )


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Every document with size, checksum, shard and slot, under the law of equal row counts.

    A null text has no bytes (size 8, checksum 0); null languages and sources come
    last in their dimension. Repeated rows get slots of their own. Rows of equal
    text meet where their metadata do. An empty table gives no rows.
    """
    rows = described(docs)
    rows = value_cells(rows, "lang", bits, "lang_cell")
    rows = value_cells(rows, "source", bits, "source_cell")
    top = (1 << bits) - 1
    rows = rows.withColumn("size_cell", F.least(F.lit(top), F.floor(F.log2("size") * F.lit(1.5))).cast("bigint"))
    cut = shard(rows, ["lang_cell", "source_cell", "size_cell"], ["size", "doc_id", "row"], shards, bits)
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
        "lang",
        "source",
    )
