import hashlib
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from walkvec.operators import dense_index, sequences
from walkvec.operators.dense_index import running_total
from walkvec.stage import stage


def _arrays(spark, *lists):
    data = [(str(i), list(x)) for i, x in enumerate(lists)]
    return spark.createDataFrame(data, "seq_id string, tokens array<int>")


def _pairs(df):
    return Counter((r.center, r.context) for r in df.collect())


def _brute(tokens, window):
    n = len(tokens)
    return Counter(
        (tokens[i], tokens[j]) for i in range(n) for j in range(max(0, i - window), min(n, i + window + 1)) if i != j
    )


@pytest.mark.parametrize(
    "tokens, window, pairs",
    [
        ([10, 11, 12], 1, {(10, 11): 1, (11, 10): 1, (11, 12): 1, (12, 11): 1}),
        ([10, 11, 12], 5, {(a, b): 1 for a in (10, 11, 12) for b in (10, 11, 12) if a != b}),
        ([10], 1, {}),
        ([10, 10], 1, {(10, 10): 2}),
    ],
)
def test_skipgram_fixtures(spark, tokens, window, pairs):
    df = _arrays(spark, tokens)
    assert _pairs(sequences.pairs_from_arrays(df, window)) == pairs
    assert _pairs(sequences.skipgram_pairs(sequences.array_positions(df), window)) == pairs


@pytest.mark.parametrize("block", [3, 4, 7, 4096])
def test_long_sequences_split_exactly(spark, block):
    rng = random.Random(block)
    tokens = [rng.randrange(9) for _ in range(40)]
    df = sequences.array_positions(_arrays(spark, tokens, [1, 2]))
    got = sequences.skipgram_pairs(df, 3, block)
    assert _pairs(got) == _brute(tokens, 3) + _brute([1, 2], 3)
    whole = rows(sequences.cbow_rows(df, 3), "seq_id", "pos", "center", F.to_json("context"))
    assert rows(sequences.cbow_rows(df, 3, block), "seq_id", "pos", "center", F.to_json("context")) == whole
    assert _pairs(sequences.pairs_from_arrays(_arrays(spark, tokens), 3)) == _brute(tokens, 3)


def test_cbow_fixture(spark):
    df = sequences.array_positions(_arrays(spark, [10, 11, 12], [5]))
    got = {r.center: r.context for r in sequences.cbow_rows(df, 1).collect()}
    assert got == {10: [11, None], 11: [10, 12], 12: [11, None]}


def test_positions_follow_the_order(spark):
    df = spark.createDataFrame([("s", 3, "c"), ("s", 1, "a"), ("t", 9, "z"), ("s", 2, "b")], "seq_id string, at int, token string")
    assert rows(sequences.positions(df, ["at"])) == [("s", 0, "a"), ("s", 1, "b"), ("s", 2, "c"), ("t", 0, "z")]


def test_ranks_by_frequency(spark):
    df = spark.createDataFrame([(t,) for t in "bbbaacd"], "token string")
    assert rows(sequences.token_ranks(df)) == [("a", 2, 1), ("b", 3, 0), ("c", 1, 2), ("d", 1, 3)]
    assert rows(sequences.token_ranks(df, min_count=2), "token", "rank") == [("a", 1), ("b", 0)]


def test_negative_ranks_are_log_uniform(spark):
    pairs = spark.range(4000).withColumnRenamed("id", "k")
    got = sequences.negatives(pairs, ["k"], F.lit(50), 5, 1).groupBy("negative").count().collect()
    counts = {r.negative: r["count"] for r in got}
    assert set(counts) <= set(range(50))
    import math

    for rank in (0, 1, 10):
        share = math.log((rank + 2) / (rank + 1)) / math.log(51)
        assert counts[rank] / 20_000 == pytest.approx(share, rel=0.15)


def test_shuffle_and_batches(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    shuffled = sequences.shuffled(df, ["k"], 42)
    order = [r.k for r in shuffled.orderBy("idx").collect()]
    assert sorted(order) == list(range(25)) and order != list(range(25))
    got = sequences.batches(shuffled, 10, epochs=3).collect()
    # 75 examples give 7 full batches; a batch may span two epochs.
    assert Counter(r.batch_id for r in got) == {i: 10 for i in range(7)}
    assert len([r for r in got if r.epoch == 0]) == 25


def test_center_side_features_are_attached(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 1), (1, 3)], "center int, context int")
    side = spark.createDataFrame([(1, "x"), (2, "y")], "node int, gds_idx string")
    assert rows(sequences.attach_side(pairs, side)) == [(1, 2, "x"), (1, 3, "x"), (2, 1, "y")]


def _staged(monkeypatch):
    """Rows written by every stage of the steps, by label."""
    written = {}

    def counting(df, label="stage"):
        out = stage(df, label)
        written[label] = written.get(label, 0) + out.count()
        return out

    for module in (sequences, dense_index):
        monkeypatch.setattr(module, "stage", counting)
    return written


def test_shuffle_writes_counts_not_examples(spark, monkeypatch):
    written = _staged(monkeypatch)
    df = spark.range(20_000).select(F.col("id").alias("k"))
    got = {r.k: r.idx for r in sequences.shuffled(df, ["k"], 42).collect()}
    order = sorted(range(20_000), key=lambda k: hashlib.md5(f"42|{k}".encode()).hexdigest())
    assert got == {k: i for i, k in enumerate(order)}
    assert sum(written.values()) <= sequences.SHUFFLE_BUCKETS


def _side_case(spark):
    """Tokens, items (two of node 1, none of node 5) and the pairs with items."""
    rng = random.Random(3)
    lists = [[rng.randrange(6) for _ in range(n)] for n in (30, 1, 7, 12)]
    tokens = sequences.array_positions(_arrays(spark, *lists))
    items = [(0, "a", 1), (1, "b", 2), (1, "c", 3), (2, "d", 4), (3, "e", 5), (4, "f", 6)]
    side = spark.createDataFrame(items, "node int, item_key string, gds_idx long")
    expected = [
        (str(s), i, j, x[i], x[j], key, gds)
        for s, x in enumerate(lists)
        for i in range(len(x))
        for j in range(max(0, i - 2), min(len(x), i + 3))
        for node, key, gds in items
        if i != j and node == x[i]
    ]
    return tokens, side, expected


def test_side_features_meet_positions_before_pairs(spark):
    tokens, side, expected = _side_case(spark)
    got = sequences.pairs_with_side(tokens, side, 2)
    assert got.columns == ["seq_id", "center_pos", "context_pos", "center", "context", "item_key", "gds_idx"]
    assert rows(got) == sorted(expected)
    bare = rows(sequences.context_pairs(sequences.context_rows(tokens, 2)).drop("place"))
    assert bare == rows(sequences.skipgram_pairs(tokens, 2))


@pytest.mark.parametrize("seed", [None, 42])
def test_training_batches_write_no_pairs(spark, monkeypatch, seed):
    tokens, side, expected = _side_case(spark)
    written = _staged(monkeypatch)
    got = sequences.training_batches(tokens, side, 2, 7, epochs=2, seed=seed).collect()

    def place(e):
        key = f"{e[0]}|{e[1]}|{e[2]}"
        return (hashlib.md5(f"42|{key}".encode()).hexdigest(), *e) if seed else e

    ordered = sorted(expected, key=place)
    n = len(ordered)
    full = 2 * n // 7
    want = [
        (*e, i, epoch, (epoch * n + i) // 7)
        for epoch in range(2)
        for i, e in enumerate(ordered)
        if (epoch * n + i) // 7 < full
    ]
    assert sorted(tuple(r) for r in got) == sorted(want)
    # Before, every pair was written with the features of its center.
    assert max(v for k, v in written.items() if k != "buckets") <= tokens.count()


def test_running_total_over_partitions(spark):
    df = spark.createDataFrame([(i * 7 % 50, i % 4) for i in range(50)], "k int, n long").repartition(5)
    got = rows(running_total(df, ["k"], "n", "start"))
    total, want = 0, []
    for k, n in rows(df):
        want.append((k, n, total))
        total += n
    assert got == want


def test_the_shuffle_of_examples_carries_no_bucket(spark):
    pairs = spark.createDataFrame([(s, i, i + 1) for s in range(3) for i in range(5)], "seq_id bigint, center_pos bigint, context_pos bigint")
    numbered = sequences.shuffled(pairs, ["seq_id", "center_pos", "context_pos"], 1)
    below = numbered._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)[1]
    assert "AS _bucket" not in below.split("_start")[0]
    assert sorted(r.idx for r in numbered.collect()) == list(range(15))
