"""Column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    An expression used inside a lambda is otherwise computed once per element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) from the first 52 bits of the md5 of the joined key.

    The same key gives the same number in any task, partitioning or retry.
    """
    key = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") / F.lit(4503599627370496.0)


# --- hashes -----------------------------------------------------------------


def md5_hex(value: Column) -> Column:
    """32 lower-case hex digits; null stays null."""
    return F.md5(value.cast("string"))


def md5_hex16(value: Column) -> Column:
    """The middle 16 hex digits of the md5."""
    return F.substring(md5_hex(value), 9, 16)


# --- dates (yyyyMMdd strings at the edges) ----------------------------------


def today_key() -> Column:
    return F.date_format(F.current_date(), "yyyyMMdd")


def date_key_diff(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``; null for an invalid date."""
    return F.datediff(F.try_to_date(end, "yyyyMMdd"), F.try_to_date(start, "yyyyMMdd"))


def date_key_add(key: Column, days: Column | int) -> Column:
    return F.date_format(F.date_add(F.try_to_date(key, "yyyyMMdd"), days), "yyyyMMdd")


def next_sunday(day: Column) -> Column:
    """The Sunday strictly after ``day`` as yyyy-MM-dd."""
    return F.date_format(F.next_day(day, "SU"), "yyyy-MM-dd")


def minute_of_day(ts: Column, hour12: bool = False) -> Column:
    """Minutes since midnight; ``hour12`` counts the hour on a 12-hour clock."""
    hour = F.hour(ts) % 12 if hour12 else F.hour(ts)
    return hour * 60 + F.minute(ts)


# --- vectors (arrays of numbers) --------------------------------------------


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalise(vector: Column) -> Column:
    """Unit vector of doubles; null for a zero vector."""
    norm = F.nullif(F.sqrt(dot(vector, vector)), F.lit(0.0))
    scaled = let(norm, lambda n: F.transform(vector, lambda x: x.cast("double") / n))
    return F.when(F.exists(vector, lambda x: x != 0), scaled)


def round_vector(vector: Column, digits: int = 6) -> Column:
    return F.transform(vector, lambda x: F.round(x.cast("double"), digits))


def vector_sum(vectors: Column, size: int) -> Column:
    """Element-wise sum of an array of equally long vectors."""
    zeros = F.array_repeat(F.lit(0.0), size)
    return F.aggregate(
        vectors, zeros, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y.cast("double"))
    )


def softmax(values: Column) -> Column:
    """exp and normalise to sum 1, shifted by the maximum against overflow."""
    exps = let(F.array_max(values), lambda m: F.transform(values, lambda x: F.exp(x - m)))

    def over_total(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
        return let(total, lambda t: F.transform(e, lambda x: x / t))

    return let(exps, over_total)


def score_from_distance(distance: Column) -> Column:
    return F.lit(1.0) - distance


def cosine_from_distance(distance: Column) -> Column:
    """Cosine of two unit vectors at this Euclidean distance."""
    return F.lit(1.0) - distance * distance / F.lit(2.0)
