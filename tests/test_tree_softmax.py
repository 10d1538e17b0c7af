import heapq
import random
from collections import Counter, deque

import numpy as np
import pytest
from conftest import rows
from test_train import _communities, _contrast

from walkvec.config import Config
from walkvec.operators import tree_softmax
from walkvec.operators.tree_softmax import TreeTraining, huffman_tree, step_gradients, tree_codes
from walkvec.plans import audience


def one_by_one(counts):
    """Codes and paths by merging two nodes at a time, leaves (rarest first) before merged nodes of equal weight."""
    leaves = deque((n, ("leaf", i)) for i, n in enumerate(sorted(counts)))
    merged, parent = deque(), {}
    for number in range(len(counts) - 1):
        two = [(leaves if not merged or leaves and leaves[0][0] <= merged[0][0] else merged).popleft() for _ in range(2)]
        for bit, (_, child) in enumerate(two):
            parent[child] = (("inner", number), bit)
        merged.append((two[0][0] + two[1][0], ("inner", number)))
    out = []
    for i in range(len(counts)):
        at, code, path = ("leaf", len(counts) - 1 - i), [], []
        while at in parent:
            at, bit = parent[at]
            code.insert(0, bit)
            path.insert(0, at[1])
        out.append((code, path))
    return out


def least_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("seed", range(40))
def test_runs_give_the_tree_of_single_merges(seed):
    rng = random.Random(seed)
    most = rng.choice([1, 2, 5, 40, 10_000])
    counts = sorted((rng.randint(1, most) for _ in range(rng.choice([1, 2, 3, 7, 64, 300]))), reverse=True)
    tree = huffman_tree(list(Counter(counts).items()))
    nodes, bits, length = tree.paths(np.arange(len(counts)))
    want = one_by_one(counts)
    for i, (code, path) in enumerate(want):
        assert bits[i, : length[i]].tolist() == code and nodes[i, : length[i]].tolist() == path
    assert int((length * np.array(counts)).sum()) == least_cost(counts)
    assert len(counts) == 1 or sum(2.0 ** -int(n) for n in length) == 1


def test_many_tokens_of_few_frequencies():
    """A billion tokens: the tree stays a short table."""
    tree = huffman_tree([(1, 700_000_000), (2, 200_000_001), (7, 99_999_999), (1_000_000, 3)])
    assert len(tree.count) < 500
    _, _, length = tree.paths(np.array([0, 2, 10_000_000, 999_999_000]))
    assert length[0] <= length[1] < length[2] < length[3] < 40


def test_codes(spark):
    ranks = spark.createDataFrame([(f"t{i}", n, i) for i, n in enumerate([9, 5, 5, 2, 1, 1])], "token string, n bigint, rank bigint")
    got = {r.token: (r.code, r.path) for r in tree_codes(ranks.repartition(3)).collect()}
    assert got == {f"t{i}": x for i, x in enumerate(one_by_one([9, 5, 5, 2, 1, 1]))}
    assert rows(tree_codes(ranks.limit(1)), "code", "path") == [([], [])]
    assert tree_codes(ranks.limit(0)).collect() == []


def test_gradient():
    rng = np.random.default_rng(1)
    centre, nodes = rng.normal(size=(3, 4)), rng.normal(size=(3, 5, 4))
    bits, on = rng.integers(0, 2, (3, 5)), np.arange(5) < np.array([5, 2, 0])[:, None]
    _, to_centre, to_nodes = step_gradients(centre, nodes, bits, on)
    for values, gradient in ((centre, to_centre), (nodes, to_nodes)):
        for at in np.ndindex(values.shape):
            loss = []
            for eps in (1e-6, -1e-6):
                values[at] += eps
                loss.append(step_gradients(centre, nodes, bits, on)[0])
                values[at] -= eps
            assert gradient[at] == pytest.approx((loss[0] - loss[1]) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("n", [1, 10, 37, 100])
def test_step_of_small_products(n):
    """The step that fetches each row once moves the rows as the plain gradients do, also for repeated centres and contexts."""
    rng = np.random.default_rng(n)
    tree = huffman_tree(list(Counter([9, 5, 5, 2, 1, 1, 1, 40, 300]).items()))
    nodes, bits, length = tree.paths(rng.integers(0, 9, n))
    centre, nodes = rng.integers(0, 4, n), np.where(nodes >= 0, nodes + 4, 0)
    got = rng.normal(size=(4 + 8, 3))
    want = got.copy()
    on = np.arange(nodes.shape[1]) < length[:, None]
    _, to_centre, to_nodes = step_gradients(want[centre], want[nodes], bits, on)
    np.add.at(want, centre, -0.1 * to_centre)
    np.add.at(want, nodes[on], -0.1 * to_nodes[on])
    tree_softmax.true_step(got, centre, nodes, bits, length, 0.1)
    assert got == pytest.approx(want, abs=1e-12)


def test_step_without_nodes():
    vec = np.ones((2, 3))
    tree_softmax.true_step(vec, np.array([0, 1]), np.zeros((2, 0), int), np.zeros((2, 0), int), np.zeros(2, int), 0.1)
    assert (vec == 1).all()


def test_probabilities_of_a_tree_sum_to_one():
    rng = np.random.default_rng(2)
    tree = huffman_tree(list(Counter([9, 5, 5, 2, 1, 1, 1]).items()))
    nodes, bits, length = tree.paths(np.arange(7))
    inner, centre = rng.normal(size=(6, 3)), rng.normal(size=(1, 3))
    total = 0.0
    for i in range(7):
        on = np.ones((1, length[i]))
        total += np.exp(-step_gradients(centre, inner[nodes[i : i + 1, : length[i]]], bits[i : i + 1, : length[i]], on)[0])
    assert total == pytest.approx(1)


@pytest.mark.parametrize("per_shard", [100_000, 300])
def test_communities_separate(spark, monkeypatch, per_shard):
    """Also with many shards, centres that are split, and sums over splits of shards."""
    small = lambda **k: TreeTraining(examples_per_shard=per_shard, rounds=2, splits=1, **k)
    monkeypatch.setattr(tree_softmax, "TreeTraining", small)
    cfg = Config(vector_size=8, window=3, iterations=4)
    got = audience.node_vectors(_communities(spark), cfg).collect()
    assert _contrast(got) > 0.3
