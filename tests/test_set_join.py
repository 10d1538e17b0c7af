"""Exact set overlap against brute force."""

from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from walkvec.operators import set_join
from walkvec.stage import stage


def _frame(spark, sets):
    data = [(i, str(e)) for i, elements in sets.items() for e in elements]
    return spark.createDataFrame(data, "id string, element string")


def _expected(sets, threshold):
    """Pairs of class representatives with their overlap, and each set's representative."""
    first = {}
    for i in sorted(sets):
        if sets[i]:
            first.setdefault(frozenset(sets[i]), i)
    reps = {i: first[frozenset(s)] for i, s in sets.items() if s}
    found = {}
    names = sorted(first.values())
    for n, a in enumerate(names):
        for b in names[n + 1 :]:
            common = len(sets[a] & sets[b])
            if 1 - common / len(sets[a] | sets[b]) < threshold and common:
                found[a, b] = common
    return found, reps


def _sample():
    rng = np.random.default_rng(4)
    base = set(range(40))
    sets = {f"n{i:02d}": base - {int(v) for v in rng.integers(0, 40, i % 9)} for i in range(24)}
    sets |= {f"c{i:02d}": set(base) for i in range(12)}
    # A hot element in every other set, sets of all sizes, one long set, one alone.
    sets |= {f"h{i:02d}": {999} | {int(v) for v in rng.integers(100, 160, 1 + i)} for i in range(30)}
    sets |= {"long": set(range(2000, 2600)), "part": set(range(2000, 2500)), "alone": {5000}}
    return sets


@pytest.mark.parametrize("threshold, block_rows", [(0.2, 3), (0.5, 2048), (0.95, 3), (1.0, 2048)])
def test_pairs_equal_brute_force(spark, threshold, block_rows):
    sets = _sample()
    pairs, classes = set_join.overlapping_sets(_frame(spark, sets), threshold, block_rows)
    want, reps = _expected(sets, threshold)
    got = pairs.collect()
    assert len(got) == len(want) and {(r.lo, r.hi): r.common for r in got} == want
    assert {r.id: r.rep for r in classes.collect()} == reps


def test_pairs_at_the_threshold_itself_are_left_out(spark):
    sets = {"a": set(range(6)), "b": set(range(12)), "c": set(range(9))}
    pairs, _ = set_join.overlapping_sets(_frame(spark, sets), 0.5)
    assert rows(pairs, "lo", "hi") == [("a", "c"), ("b", "c")]  # a and b: a distance of 0.5


def test_a_set_leaves_out_what_the_threshold_allows(spark):
    sizes = spark.createDataFrame([(1,), (5,), (20,), (21,), (100,)], "size int")
    got = sizes.select("size", set_join.tail_length(F.col("size"), 0.2).alias("tail"))
    assert rows(got) == [(1, 0), (5, 0), (20, 3), (21, 4), (100, 19)]


def test_repeated_rows_nulls_and_empty_tables(spark):
    data = [("a", "1"), ("a", "1"), ("a", "2"), ("b", "2"), ("b", "1"), ("c", None), (None, "1"), ("d", "2")]
    frame = spark.createDataFrame(data, "id string, element string")
    pairs, classes = set_join.overlapping_sets(frame.withColumn("size", F.lit(7)), 0.9)
    assert rows(classes) == [("a", "a", 2), ("b", "a", 2), ("d", "d", 1)]
    assert rows(pairs) == [("a", "d", 1, 0.5)]
    pairs, classes = set_join.overlapping_sets(frame.where("id = 'none'"), 0.9)
    assert rows(pairs) == [] and rows(classes) == []


def test_threshold_must_be_a_distance(spark):
    with pytest.raises(ValueError):
        set_join.overlapping_sets(_frame(spark, {"a": {1}}), 0.0)


def test_no_pair_leaves_a_task_that_cannot_be_near(spark, monkeypatch):
    seen = {}

    def recorded(df, label="stage"):
        out = stage(df, label)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(set_join, "stage", recorded)
    sets = {f"s{i:02d}": {0} | set(range(100 * (i + 1), 100 * (i + 1) + 29)) for i in range(20)}
    sets["t"] = sets["s00"] | {1}
    pairs, _ = set_join.overlapping_sets(_frame(spark, sets), 0.5)
    assert rows(pairs, "lo", "hi", "common") == [("s00", "t", 30)]
    # Before, every two sets that met in a list were written and shuffled: 210 pairs.
    assert seen["counted"] == 1


@pytest.mark.parametrize("block_rows", [2, 100])
def test_members_of_a_list_meet_once(spark, block_rows):
    data = [(e, i) for e, numbers in {"a": range(9), "b": range(3, 5), "c": [7]}.items() for i in numbers]
    lists = set_join.later_members(spark.createDataFrame(data + data[:3], "e string, number int"), ["e"], block_rows).collect()
    want = [(i, j) for i in range(9) for j in range(i + 1, 9)] + [(3, 4)]
    assert sorted((r.lo, hi) for r in lists for hi in r.his) == sorted(want)
    assert max(len(r.his) for r in lists) <= block_rows


def test_counts_go_on_over_batches_and_slices(spark):
    rng = np.random.default_rng(8)
    data = [(int(lo), sorted(int(v) for v in rng.choice(np.arange(9, 30), 4, False))) for lo in rng.integers(0, 9, 80)]
    lists = spark.createDataFrame(data, "lo int, his array<int>")
    left = spark.createDataFrame([(2, 5)], "number int, n long")
    want = Counter((lo, hi) for lo, his in data for hi in his)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        for most, at_once in ((0, 1 << 20), (0, 5), (4, 5)):
            sizes = lambda numbers: np.full(len(numbers), 12, np.int64)
            bound = lambda a, b, n: np.minimum(n, most)  # noqa: E731, B023
            got = set_join.count_met(lists, sizes, 0.2, bound, left_out=left, at_once=at_once)
            near = {p: c for p, c in want.items() if c + (most if p[0] == 2 else 0) >= 4}
            assert {(r.lo, r.hi): r.common for r in got.collect()} == near
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
