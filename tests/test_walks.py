from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from walkvec.operators import graph, walks

CHAIN = [(0, 0, 1, 36), (0, 1, 0, 36), (0, 1, 2, 64), (0, 2, 1, 64)]


def _text(walked):
    return walked.select("seg_id", F.array_join("nodes", " ").alias("value"))


def _trans(spark, edges, top=100):
    df = spark.createDataFrame(edges, "seg_id int, src bigint, dst bigint, units bigint")
    return graph.transitions(df, top)


def test_greedy(spark):
    got = walks.random_walks(_trans(spark, CHAIN), 4, 1, strategy="greedy")
    assert rows(_text(got), "value") == [("0 1 2 1 2",), ("1 2 1 2 1",), ("2 1 2 1 2",)]


def test_greedy_ties_go_to_the_larger_id(spark):
    star = [(0, 0, d, 5) for d in (1, 2, 3)] + [(0, d, 0, 5) for d in (1, 2, 3)]
    got = rows(_text(walks.random_walks(_trans(spark, star), 1, 1, "greedy")), "value")
    assert ("0 3",) in got


@pytest.mark.parametrize("draw, node", [(0.10, 0), (0.50, 2), (0.36, 2)])
def test_weighted_choice(spark, draw, node):
    from pyspark.sql import functions as F

    adj = graph.adjacency(_trans(spark, CHAIN)).where("node_id = 1")
    chosen = adj.select(walks.next_node("weighted", "renormalize", F.lit(draw)).alias("n"))
    assert chosen.first().n == node


def test_truncation_and_leak(spark):
    from pyspark.sql import functions as F

    hub = [(0, 0, d, 1) for d in range(1, 151)]
    trans = _trans(spark, hub)
    assert sorted(r.dst for r in trans.collect()) == list(range(1, 101))
    assert trans.first().prob == pytest.approx(1 / 150)
    adj = graph.adjacency(trans)

    def pick(dead_end):
        return adj.select(walks.next_node("weighted", dead_end, F.lit(0.70)).alias("n")).first().n

    assert pick("leak") is None
    assert pick("renormalize") == 71


def test_dead_ends(spark):
    # Node 1 has no way on: its whole weight was cut.
    line = [(0, 0, 1, 1), (0, 2, 0, 1)]
    trans = _trans(spark, line)
    none = spark.createDataFrame(
        [(0, 1, 0, 0, 1, 0.0)], "seg_id int, src bigint, dst bigint, units bigint, degree_units bigint, prob double"
    )
    trans = trans.select("seg_id", "src", "dst", "units", "degree_units", "prob").union(none)

    def run(steps, **options):
        got = walks.random_walks(trans, steps, 1, dead_end="leak", **options)
        return sorted(v for (v,) in rows(_text(got), "value"))

    assert run(2) == ["0 1", "2 0 1"]
    assert run(2, keep_sentinel=True) == ["0 1 -1", "2 0 1"]
    assert run(3) == ["2 0 1"]


@pytest.mark.parametrize("strategy", walks.STRATEGIES)
def test_walks_follow_edges_and_start_everywhere(spark, strategy):
    ring = [(0, i, (i + s) % 20, 1 + i) for i in range(20) for s in (1, 19)]
    trans = _trans(spark, ring)
    got = walks.random_walks(trans, 5, 3, strategy=strategy, stage_every=2).collect()
    assert Counter(r.nodes[0] for r in got) == {i: 3 for i in range(20)}
    assert all(len(r.nodes) == 6 for r in got)
    steps = {(a, b) for _, a, b, _ in ring}
    assert all(p in steps for r in got for p in zip(r.nodes, r.nodes[1:]))


def test_walks_do_not_depend_on_partitioning(spark):
    ring = [(0, i, (i + s) % 20, 1 + i % 3) for i in range(20) for s in (1, 2, 18, 19)]
    results = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(_text(walks.random_walks(_trans(spark, ring), 6, 2))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_weighted_frequencies(spark):
    edges = [(0, 0, 1, 1), (0, 0, 2, 3), (0, 1, 0, 1), (0, 2, 0, 3)]
    got = walks.random_walks(_trans(spark, edges), 1, 2000).where("nodes[0] = 0").collect()
    share = sum(r.nodes[1] == 2 for r in got) / len(got)
    assert share == pytest.approx(0.75, abs=0.04)


def test_single_walks_have_the_given_length(spark):
    got = walks.single_walks(_trans(spark, CHAIN), 4).collect()
    assert [len(r.nodes) for r in got] == [4, 4, 4]


def test_visit_histogram(spark):
    df = spark.createDataFrame([(0, [0, 1, 2]), (0, [0, 1])], "seg_id int, nodes array<bigint>")
    assert rows(walks.visit_histogram(df)) == [(1, 1), (2, 2)]


def test_edge_list_goes_both_ways(spark):
    df = spark.createDataFrame([(1, 2, 0.5)], "src bigint, dst bigint, weight double")
    got = graph.edges_from_list(df).select("seg_id", "src", "dst", graph.published_weight())
    assert rows(got) == [(0, 1, 2, 0.5), (0, 2, 1, 0.5)]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        walks.random_walks(_trans(spark, CHAIN), 2, 1, strategy="other")
