"""Numbers drawn in the workers equal those of the expression."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from walkvec.functions.draws import with_uniforms
from walkvec.functions.scalar import uniform
from walkvec.operators import walks
from walkvec.operators.tree_softmax import add_rows


def test_draws_equal_the_expression(spark):
    keys = [None, "", "a", "ü|x", *["k" * n for n in (40, 47, 48, 49, 50, 51, 52, 53, 54, 60, 130)]]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string").repartition(2)
    parts = [1, 2, 10, 159]
    want = {
        (r.id, p): r[f"u{p}"] for r in df.select("id", *[uniform(7, F.col("k"), p).alias(f"u{p}") for p in parts]).collect() for p in parts
    }
    lists = with_uniforms(df, "u", parts, 7, F.col("k")).collect()
    assert {(r.id, p): u for r in lists for p, u in zip(parts, r.u, strict=True)} == want
    assert with_uniforms(df.limit(0), "u", parts, F.col("k")).collect() == []


def test_greedy_walks_need_no_lists(spark, monkeypatch):
    """Nothing is drawn, so a node's walks are made once, from its heaviest neighbour (ties: the larger id)."""
    edges = [(0, 1, 2, 5), (0, 1, 3, 5), (0, 2, 1, 5), (0, 3, 1, 5), (0, 3, 4, 9), (0, 4, 3, 9), (0, 5, 6, 1), (None, 1, 2, 4)]
    trans = spark.createDataFrame([(*e, 20) for e in edges], "seg_id int, src bigint, dst bigint, units bigint, degree_units bigint")
    monkeypatch.setattr(walks, "adjacency", lambda *a, **k: pytest.fail("lists of neighbours"))
    got = walks.random_walks(trans, 3, 2, strategy="greedy").collect()
    paths = {1: [1, 3, 4, 3], 2: [2, 1, 3, 4], 3: [3, 4, 3, 4], 4: [4, 3, 4, 3]}
    assert {r.walk_id: r.nodes for r in got} == {f"0|{n}|{k}": p for n, p in paths.items() for k in (1, 2)}
    assert len(got) == 8


def test_rows_are_added_once_per_row():
    rng = np.random.default_rng(0)
    table, at, values = rng.normal(size=(6, 3)), rng.integers(0, 5, 40), rng.normal(size=(40, 3))
    want = table.copy()
    np.add.at(want, at, values)
    add_rows(table, at, values)
    assert np.allclose(table, want, atol=1e-12)
