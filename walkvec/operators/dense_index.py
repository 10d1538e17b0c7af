"""Consecutive numbers 0, 1, 2, … per group without one task per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkvec.stage import stage

# monotonically_increasing_id keeps the partition above bit 33 and the row
# position within the partition below it.
_POSITION_BITS = 33


def dense_index(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "idx",
    many_groups: bool = False,
) -> DataFrame:
    """Rank of each row in its group by ``order``, minus one.

    Rows are range-partitioned by (group, order), so a group of any size spans
    as many tasks as it needs. Each partition numbers its own rows; groups that
    cross partitions get the count of their rows in earlier partitions added.
    ``order`` must be unique within a group for the result to be fixed.

    With few groups the start of each (partition, group) is looked up; with
    ``many_groups`` it is found by a window and only groups that cross a
    partition border (fewer than there are partitions) are looked up.
    """
    group = list(group)
    keys = [*group, *order]
    columns = df.columns
    numbered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Both passes below must see the same partition borders: write them down.
    rows = (
        stage(numbered, "index")
        .withColumn("_part", F.shiftright("_mid", _POSITION_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
    )
    spans = rows.groupBy("_part", *group).agg(
        F.min("_pos").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = (
        Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = spans.withColumn("_base", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    on = ["_part", *group]
    if many_groups:
        # A group that began in an earlier partition is the first one of this
        # partition, hence at most one row per partition.
        carried = spans.where("_base > 0").select(*on, "_base")
        local = F.row_number().over(Window.partitionBy(*on).orderBy("_pos")) - 1
        joined = rows.withColumn("_local", local).join(carried, on, "left")
        index = F.col("_local") + F.coalesce("_base", F.lit(0))
    else:
        joined = rows.join(spans, on)
        index = F.col("_pos") - F.col("_first") + F.col("_base")
    return joined.select(*columns, index.cast("bigint").alias(name))


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """The sum of ``value`` (a bigint) over all rows that come earlier in ``order``.

    Rows are range-partitioned and written once; each partition adds up its own
    rows as they stream by, and the sums of the partitions before it are added.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                values = batch.column(value)
                sums = pc.cumulative_sum(values, start=total)
                total = sums[-1].as_py()
                columns = [*batch.columns, pc.subtract(sums, values)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(add_up, schema)
    rows = stage(ordered.withColumn("_part", F.spark_partition_id()), "running")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("_part").agg(F.sum(value).alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")
    )
    joined = rows.join(F.broadcast(base), "_part")
    return joined.select(*df.columns, (F.col(name) + F.col("_base")).alias(name))
