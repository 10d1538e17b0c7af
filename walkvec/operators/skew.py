"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64
HOT_PARTS = 1_000
HOT_ROWS = 100_000


def salt_of(column: str | Sequence[str], salts: int = SALTS):
    columns = [column] if isinstance(column, str) else column
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def with_salts(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """One copy of each row per salt."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    spread: str | Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table`` (unique on ``keys``) whatever the key skew.

    A key is hot if it has more than ``hot_rows`` rows and more than 1/1000 of
    all rows; so there are fewer than 1000 hot keys and their table rows can be
    broadcast. Hot rows take their values from that broadcast, and in the
    shuffle join they (and rows with a null key) carry a null key and a salt of
    ``spread``, which scatters them. Every row appears exactly once, as in a plain join.
    """
    keys = list(keys)
    payload = [c for c in table.columns if c not in keys]
    found = table.select(*keys, F.struct(F.lit(True).alias("_hit"), *payload).alias("_cold"))

    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    hot = counts.where(
        (F.col("_rows") > hot_rows) & (F.col("_rows") * HOT_PARTS > total)
    ).select(*keys)
    hot = hot.join(found.withColumnRenamed("_cold", "_hot"), keys, "left").withColumn(
        "_is_hot", F.lit(True)
    )

    renamed = [f"_k_{k}" for k in keys]
    cold_keys = [F.when(F.col("_is_hot").isNull(), F.col(k)).alias(r) for k, r in zip(keys, renamed)]
    unmatched = F.col("_is_hot").isNotNull()
    for k in keys:
        unmatched = unmatched | F.col(k).isNull()
    salt = F.when(unmatched, salt_of(spread, 1 << 20)).otherwise(F.lit(0))
    marked = rows.join(F.broadcast(hot), keys, "left").select("*", *cold_keys, salt.alias("_salt"))
    table_side = found.select(
        *[F.col(k).alias(r) for k, r in zip(keys, renamed)], F.lit(0).alias("_salt"), "_cold"
    )
    joined = marked.join(table_side, [*renamed, "_salt"], "left")
    value = F.coalesce("_hot", "_cold")
    if how == "inner":
        joined = joined.where(value.isNotNull())
    return joined.select(*rows.columns, *[value[c].alias(c) for c in payload])


def anti_join_hot(rows: DataFrame, hot: DataFrame, key: str, spread: str) -> DataFrame:
    """Drop the rows whose ``key`` is listed in ``hot``, the largest keys there are.

    The list grows with the data, so it is not broadcast by hint: each listed
    key is copied once per salt and its rows spread over that many tasks.
    """
    return (
        rows.withColumn("_salt", salt_of(spread))
        .join(with_salts(hot.select(key)), [key, "_salt"], "left_anti")
        .drop("_salt")
    )
