"""Demographic segments and the node index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.config import GENDER_CODES
from walkvec.operators.dense_index import dense_index


def bucket_label(
    value: Column,
    known: Sequence[str],
    aliases: Sequence[tuple[str, str]] = (),
    other: str = "-",
) -> Column:
    """Known labels as they are, aliases replaced, anything else (or null) ``other``."""
    out = F.when(value.isin(list(known)), value)
    for alias, label in aliases:
        out = out.when(value == alias, F.lit(label))
    return out.otherwise(F.lit(other))


def label_position(label: Column, labels: Sequence[str]) -> Column:
    """Position of a label in the ordered list of labels."""
    return (F.array_position(F.array(*[F.lit(x) for x in labels]), label) - 1).cast("int")


def one_per_member(base: DataFrame) -> DataFrame:
    """One base row per member: the smallest (age group, gender)."""
    row = F.min(F.struct("age_group", "gender_cd"))
    return base.groupBy("memb_id").agg(row.alias("_r")).select("memb_id", "_r.*")


def assign_segments(
    members: DataFrame,
    base: DataFrame,
    labels: Sequence[str],
    aliases: Sequence[tuple[str, str]] = (),
    statis_date: str | None = None,
    gender_codes: Sequence[str] = GENDER_CODES,
    dedupe_base: bool = True,
) -> DataFrame:
    """LEFT JOIN the members to the base table and bucket age group and gender.

    ``statis_date`` prunes partitions of the base table. ``dedupe_base=False``
    lets several base rows multiply a member.
    """
    if statis_date is not None:
        base = base.where(F.col("statis_date") == statis_date)
    base = one_per_member(base) if dedupe_base else base.select("memb_id", "age_group", "gender_cd")
    segment = bucket_label(F.col("age_group"), labels[:-1], aliases, labels[-1])
    return (
        members.select("member_id")
        .join(base.withColumnRenamed("memb_id", "member_id"), "member_id", "left")
        .select(
            "member_id",
            segment.alias("segment"),
            bucket_label(F.col("gender_cd"), gender_codes).alias("gender"),
        )
        .withColumn("seg_id", label_position(F.col("segment"), labels))
    )


def node_index(segmented: DataFrame) -> DataFrame:
    """Number the members of each segment from 0 in the order of their ids."""
    rows = segmented.select("member_id", "seg_id")
    return dense_index(rows, ["seg_id"], ["member_id"], "node_id").select(
        "member_id", "node_id", "seg_id"
    )
