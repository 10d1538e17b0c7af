"""Exact set overlap: every pair of sets nearer than a Jaccard distance, from inverted lists.

Two sets with more than a share j of their union in common share more than j times the size of either.
So a set may leave its most frequent elements, its tail, out of the lists: as long as the tail is not larger
than that, every true pair still meets at an element of both heads. At a low threshold only elements of long
lists are left out. Sets are numbered by size. No pair travels: a set is sent the part of each list with the
numbers above its own, four bytes each, and counts them where its lists meet; a number tells the size, so
only pairs that may still reach the threshold leave the task. They have the rest counted, through the tails.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.operators.cells import BLOCK_ROWS
from walkvec.operators.dense_index import dense_index
from walkvec.operators.skew import lookup
from walkvec.stage import stage

_ROUNDING = 1e-9  # a tail rather one element too short than one too long
_LOW_SHARE = 0.25  # below, tails are short and only spare long lists
_SLICE = 1 << 20  # numbers counted at once


def set_classes(sets: DataFrame) -> DataFrame:
    """Each set's class (id, rep, size): equal sets share the smallest of their ids as ``rep``.

    ``sets`` has distinct (id, element) rows. Sets are compared by size and two 64-bit digests, so none is collected.
    """
    digests = sets.groupBy("id").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("element")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "element")).alias("x2"),
    )
    digests = stage(digests, "digests")
    same = ["size", "x1", "x2"]
    reps = digests.groupBy(*same).agg(F.min("id").alias("rep"))
    return lookup(digests, reps, same, spread="id", how="inner").select("id", "rep", "size")


def tail_length(size: Column, share: float) -> Column:
    """Elements a set of ``size`` can leave out of the lists when pairs must have more than ``share`` in common."""
    return F.greatest(F.ceil(size * share - _ROUNDING) - 1, F.lit(0)).cast("bigint")


def numbered(reps: DataFrame) -> tuple[DataFrame, Callable[[np.ndarray], np.ndarray]]:
    """``reps`` (id, size, …) with an int ``number``, by size and id, and the sizes of an array of numbers.

    The driver holds one row per distinct size, so at most about the root of twice the number of elements.
    """
    reps = stage(dense_index(reps, [], ["size", "id"], "number").withColumn("number", F.col("number").cast("int")), "numbered")
    counts = sorted(tuple(r) for r in reps.groupBy("size").count().collect())
    sizes = np.array([r[0] for r in counts], np.int64)
    ends = np.cumsum([r[1] for r in counts])
    return reps, lambda numbers: sizes[np.searchsorted(ends, numbers, "right")]


def later_members(rows: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    """(lo, his): for every list of ``keys`` and every member but the last, the members above it.

    ``rows`` has the keys and an int ``number``. A list of more than ``block_rows`` members is cut into blocks
    of consecutive members, and every two blocks meet in a cell; so no row is longer than a block.
    """
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > block_rows).select(*keys)
    large = stage(large, "large_lists")
    found = None
    if not large.isEmpty():
        blocks = dense_index(rows.join(large, keys, "left_semi").distinct(), keys, ["number"], "_at")
        blocks = blocks.withColumn("_b", F.floor(F.col("_at") / block_rows).cast("int")).groupBy(*keys, "_b")
        blocks = stage(blocks.agg(F.sort_array(F.collect_list("number")).alias("_list")), "blocks")
        counts = blocks.groupBy(*keys).agg(F.max("_b").alias("_last"))
        first = blocks.join(counts, keys).select(*keys, "_b", "_list", F.explode(F.sequence("_b", "_last")).alias("_other"))
        second = blocks.select(*keys, F.col("_b").alias("_other"), F.col("_list").alias("_his"))
        cells = first.join(second, [*keys, "_other"]).select("_b", "_other", "_his", F.posexplode("_list").alias("_at", "lo"))
        own = F.slice("_his", F.col("_at") + 2, F.size("_his"))
        found = cells.select("lo", F.when(F.col("_b") == F.col("_other"), own).otherwise(F.col("_his")).alias("his"))
        rows = rows.join(large, keys, "left_anti")
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_set("number")).alias("_list")).where(F.size("_list") > 1)
    short = lists.select("_list", F.posexplode("_list").alias("_at", "lo"))
    short = short.select("lo", F.slice("_list", F.col("_at") + 2, F.size("_list")).alias("his"))
    return (short if found is None else short.unionByName(found)).where(F.size("his") > 0)


def count_met(
    lists: DataFrame,
    size_of: Callable[[np.ndarray], np.ndarray],
    share: float,
    most_left: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    candidates: DataFrame | None = None,
    left_out: DataFrame | None = None,
    at_once: int = _SLICE,
) -> DataFrame:
    """(lo, hi, common): how often two numbers met in ``lists`` (lo, his), if they may reach the share.

    ``left_out`` (number, n) tells how many elements of a set are in no list. ``most_left`` bounds those that two
    sets have in common, from their sizes and the n of the first. With ``candidates`` (lo, his) only pairs
    from there come out, also those that never met in ``lists``.

    What a set receives is shuffled and sorted by its number, and counted as it streams by, ``at_once`` numbers at a time.
    """
    with_candidates = candidates is not None
    rows = lists.select("lo", F.lit(1).cast("tinyint").alias("kind"), "his")
    if with_candidates:
        rows = rows.unionByName(candidates.select("lo", F.lit(0).cast("tinyint").alias("kind"), "his"))
    if left_out is not None:
        spare = F.array(F.col("n").cast("int"))
        rows = rows.unionByName(left_out.select(F.col("number").alias("lo"), F.lit(2).cast("tinyint").alias("kind"), spare.alias("his")))
    factor = max(share, 0.0) / (1.0 + max(share, 0.0))
    low = np.int64(0xFFFFFFFF)

    def judged(keys: np.ndarray, times: np.ndarray, spare: dict[int, int]) -> pa.RecordBatch:
        # keys: lo, hi and whether the row is of a list; for every pair the candidate comes first.
        pairs = keys >> 1
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        listed = np.where(keys & 1, times, 0)
        common = np.add.reduceat(listed, first) if len(first) else listed
        wanted = (keys[first] & 1) == 0 if with_candidates else np.ones(len(first), bool)
        pairs, common = pairs[first][wanted], common[wanted]
        lo, hi = pairs >> 31, pairs & (low >> 1)
        left = np.zeros(len(lo), np.int64)
        if spare:
            at = np.array(sorted(spare), np.int64)
            n = np.array([spare[int(a)] for a in at], np.int64)
            place = np.minimum(np.searchsorted(at, lo), len(at) - 1)
            left = np.where(at[place] == lo, n[place], 0)
        a, b = size_of(lo), size_of(hi)
        near = common + most_left(a, b, left) >= (a + b) * factor - _ROUNDING
        columns = [lo[near].astype(np.int32), hi[near].astype(np.int32), common[near]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["lo", "hi", "common"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of numbers that more rows may follow
        spare: dict[int, int] = {}
        for batch in batches:
            los, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            column = batch.column(2)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            row = 0
            while row < len(los):
                start = ends[row] - lengths[row]
                stop = max(row + 1, int(np.searchsorted(ends, start + at_once, "right")))
                lo, kind = los[row:stop].astype(np.int64), kinds[row:stop]
                his = values[start : ends[stop - 1]].astype(np.int64)
                row_of = np.repeat(np.arange(stop - row), lengths[row:stop])
                plain = kind[row_of] != 2
                spare |= dict(zip(lo[kind == 2].tolist(), his[~plain].tolist()))
                new = ((lo[row_of] << 32) | (his << 1) | kind[row_of])[plain]
                new, count = np.unique(new, return_counts=True)
                if len(keys):
                    keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                    times = np.bincount(at, np.concatenate([times, count])).astype(np.int64)
                else:
                    keys, times = new, count.astype(np.int64)
                # The last number may go on; the others are complete.
                cut = int(np.searchsorted(keys, lo[-1] << 32))
                if cut:
                    yield judged(keys[:cut], times[:cut], spare)
                    keys, times = keys[cut:], times[cut:]
                spare = {k: v for k, v in spare.items() if k >= lo[-1]}
                row = stop
        if len(keys):
            yield judged(keys, times, spare)

    return rows.repartition("lo").sortWithinPartitions("lo").mapInArrow(run, "lo int, hi int, common bigint")


def named_pairs(counted: DataFrame, numbers: DataFrame) -> DataFrame:
    """Pairs of numbers as pairs of ids (lo, hi, lo < hi) with their sizes and common elements."""
    own = numbers.select(F.col("number").alias("lo"), F.col("id").alias("id_a"), F.col("size").alias("size_a"))
    other = numbers.select(F.col("number").alias("hi"), F.col("id").alias("id_b"), F.col("size").alias("size_b"))
    both = counted.join(own, "lo").join(other, "hi")
    ordered = F.col("id_a") < F.col("id_b")

    def pick(a: str, b: str, name: str) -> Column:
        return F.when(ordered, F.col(a)).otherwise(F.col(b)).alias(name)

    return both.select(
        pick("id_a", "id_b", "lo"), pick("id_b", "id_a", "hi"),
        pick("size_a", "size_b", "size_lo"), pick("size_b", "size_a", "size_hi"), "common",
    )


def _tails(rows: DataFrame, least: int, share: float) -> DataFrame | None:
    """The elements (element, number, size) in the tail of their set; only those in more than ``least`` sets are tried."""
    counts = rows.groupBy("element").agg(F.count("*").alias("lists")).where(F.col("lists") > least)
    counts = stage(counts, "frequencies")
    if counts.isEmpty():
        return None
    long = rows.where(tail_length(F.col("size"), share) > 0)
    long = lookup(long, counts, ["element"], spread="number", how="inner")
    # A set of any size spans as many tasks as it needs here.
    order = long.withColumn("rarity", -F.col("lists"))
    placed = dense_index(order, ["number"], ["rarity", "element"], "place", many_groups=True)
    tails = placed.where(F.col("place") < tail_length(F.col("size"), share)).select("element", "number", "size")
    return stage(tails, "tails")


def _tail_overlap(open_pairs: DataFrame, rows: DataFrame, heads: DataFrame, tails: DataFrame) -> DataFrame:
    """Common elements (lo, hi, rest) that the lists did not count: those in the tail of either set."""

    def of(side: str, elements: DataFrame) -> DataFrame:
        return elements.select(F.col("number").alias(side), "element")

    pairs = open_pairs.select("lo", "hi")
    first = pairs.join(of("lo", tails), "lo").join(of("hi", rows), ["hi", "element"])
    second = pairs.join(of("hi", tails), "hi").join(of("lo", heads), ["lo", "element"])
    both = first.select("lo", "hi").unionByName(second.select("lo", "hi"))
    return both.groupBy("lo", "hi").agg(F.count("*").alias("rest"))


def overlapping_sets(
    sets: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """All pairs of different sets with a Jaccard distance below ``threshold``, exactly.

    ``sets`` has (id, element) rows; repeated rows count once, rows with a null are no element, and a set without
    elements is near to nothing. Returns the pairs of representatives (lo, hi, common, distance), lo < hi, and
    the classes (id, rep, size) of equal sets: the form to store, as it grows with the links and not with
    the square of a group of copies. ``threshold`` must lie in (0, 1]; at 1 every two sets that share an element are linked.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    share = 1.0 - threshold
    sets = stage(sets.select("id", "element").dropna().distinct(), "sets")
    classes = stage(set_classes(sets), "classes")
    numbers, size_of = numbered(classes.where(F.col("id") == F.col("rep")).select("id", "size"))
    # A set's size is its number of rows.
    rows = lookup(sets, numbers, ["id"], "element", "inner", counts=classes.select("id", F.col("size").alias("_rows")))
    rows = stage(rows.select("element", "number", "size"), "rows")
    tails = _tails(rows, block_rows if share < _LOW_SHARE else 0, share)
    whole_lists = tails is None
    heads = rows if whole_lists else rows.join(tails, ["number", "element"], "left_anti")

    def tail(size: np.ndarray) -> np.ndarray:
        return np.maximum(np.ceil(size * share - _ROUNDING).astype(np.int64) - 1, 0)

    def most_left(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        # The tails are cut from one order of all elements: what is left out of one set and in the
        # other one is in the tail that begins first.
        return np.zeros_like(a) if whole_lists else np.maximum(tail(a), tail(b))

    lists = later_members(heads.select("element", "number"), ["element"], block_rows)
    counted = stage(count_met(lists, size_of, share, most_left), "counted")
    if not whole_lists:
        rest = _tail_overlap(counted, rows, heads, tails)
        counted = counted.join(rest, ["lo", "hi"], "left").withColumn(
            "common", F.col("common") + F.coalesce("rest", F.lit(0))
        )
    whole = named_pairs(counted, numbers)
    distance = F.lit(1.0) - F.col("common") / (F.col("size_lo") + F.col("size_hi") - F.col("common"))
    pairs = whole.select("lo", "hi", "common", distance.alias("distance")).where(F.col("distance") < threshold)
    return pairs, classes
