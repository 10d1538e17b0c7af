"""Skip-gram with a hierarchical softmax over a Huffman tree of the tokens.

The tree is built from the number of tokens of each frequency, not from the tokens:
of the nodes with the least weight all pairs are merged at once into a run of nodes of
twice the weight. So the tree is a table of runs, of which there are some as many as distinct
frequencies times the logarithm of the vocabulary, however many tokens there are, and
a token's path follows from its rank by looking the runs up. Ties and pairing are those of
merging one by one from two queues, leaves first.

Training keeps the vectors in a table (pid, vec): tokens at 2 * rank, inner nodes at
2 * number + 1. Examples fall into shards by their centre, a centre with very many of
them into several. A shard takes its rows, makes true steps of ``batch`` examples each, and
returns what its rows moved by. A round runs a part of the shards; then each row moves
by the sum of its moves, or nearer to their mean the more examples used it, as moves
along the same gradient from many shards would overshoot. No task holds the model.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkvec.functions.scalar import uniform
from walkvec.operators.skew import lookup
from walkvec.stage import stage

# --- the tree -----------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Runs of equal nodes; a node is (run, index). Leaf runs come first, by rising frequency.

    The first node of a run may be the second child of ``first``, its last one the first
    child of ``last``; those between are paired, from ``start`` on, into the nodes of ``pair``.
    ``base`` numbers the nodes: leaves from the rarest token on, inner nodes as they are made.
    """

    tokens: int
    count: np.ndarray
    base: np.ndarray
    first: np.ndarray
    pair: np.ndarray
    start: np.ndarray
    last: np.ndarray
    leaf_runs: int

    def paths(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inner nodes and bits of the tokens' paths from the root, filled up behind, and their lengths."""
        place = self.tokens - 1 - np.asarray(ranks, np.int64)
        run = np.searchsorted(self.base[: self.leaf_runs], place, "right") - 1
        index = place - self.base[run]
        top, nodes, bits = len(self.count) - 1, [], []
        length = np.zeros(len(place), np.int64)
        while (below := run != top).any():
            is_first = (index == 0) & (self.first[run] >= 0)
            is_last = ~is_first & (index == self.count[run] - 1) & (self.last[run] >= 0)
            inside = index - self.start[run]
            parent = np.where(is_first, self.first[run], np.where(is_last, self.last[run], self.pair[run]))
            bit = np.where(is_first, 1, np.where(is_last, 0, inside % 2))
            run = np.where(below, parent, run)
            index = np.where(below, np.where(is_first | is_last, 0, inside // 2), index)
            nodes.append(np.where(below, self.base[run] + index, -1))
            bits.append(np.where(below, bit, 0))
            length += below
        if not nodes:
            return np.zeros((len(place), 0), np.int64), np.zeros((len(place), 0), np.int64), length
        # From the leaf upwards so far; turn each path round.
        step = length[:, None] - 1 - np.arange(len(nodes))
        on = step >= 0
        at = np.where(on, step, 0)
        up, turn = np.stack(nodes, 1), np.stack(bits, 1)
        rows = np.arange(len(place))[:, None]
        return np.where(on, up[rows, at], -1), np.where(on, turn[rows, at], 0), length


def huffman_tree(frequencies: list[tuple[int, int]]) -> Tree:
    """The tree for pairs (frequency, number of tokens that have it)."""
    ordered = sorted(frequencies)
    weight, count = [f for f, _ in ordered], [c for _, c in ordered]
    base = [0, *np.cumsum(count).tolist()][: len(count)]
    first, pair, start, last = ([-1] * len(count) for _ in range(4))
    leaves, merged = deque(range(len(count))), deque()
    used = [0] * len(count)  # nodes of each run that have a parent
    made = 0

    def least() -> deque:
        if not merged or (leaves and weight[leaves[0]] <= weight[merged[0]]):
            return leaves
        return merged

    def new_run(w: int, c: int) -> int:
        nonlocal made
        weight.append(w), count.append(c), base.append(made), used.append(0)
        for link in (first, pair, start, last):
            link.append(-1)
        made += c
        merged.append(len(count) - 1)
        return len(count) - 1

    def done(queue: deque) -> None:
        if used[queue[0]] == count[queue[0]]:
            queue.popleft()

    while leaves or merged:
        queue = least()
        run = queue[0]
        free = count[run] - used[run]
        if free > 1:
            start[run] = used[run]
            used[run] += free // 2 * 2
            pair[run] = new_run(2 * weight[run], free // 2)
            done(queue)
            continue
        queue.popleft()
        if not leaves and not merged:
            break
        queue = least()
        other = queue[0]
        last[run] = first[other] = new_run(weight[run] + weight[other], 1)
        used[other] += 1
        done(queue)
    columns = [np.array(x, np.int64) for x in (count, base, first, pair, start, last)]
    return Tree(sum(c for _, c in ordered), *columns, len(ordered))


def tree_of(ranks: DataFrame) -> Tree:
    """The tree of a vocabulary (token, n, rank); the driver gets one row per distinct frequency."""
    return huffman_tree([(r.n, r.tokens) for r in ranks.groupBy("n").agg(F.count("*").alias("tokens")).collect()])


def tree_codes(ranks: DataFrame) -> DataFrame:
    """(token, n, rank, code, path): each token's bits and inner nodes from the root on.

    A vocabulary of one token has an empty path.
    """
    tree = tree_of(ranks)
    kind = ranks.schema["token"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, bits, length = tree.paths(batch.column(2).to_numpy())
            on = np.arange(nodes.shape[1]) < length[:, None]
            ends = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
            code = pa.ListArray.from_arrays(ends, pa.array(bits[on].astype(np.int32)))
            path = pa.ListArray.from_arrays(ends, pa.array(nodes[on]))
            yield pa.RecordBatch.from_arrays([*batch.columns, code, path], names=["token", "n", "rank", "code", "path"])

    schema = f"token {kind}, n bigint, rank bigint, code array<int>, path array<bigint>"
    return ranks.select("token", F.col("n").cast("bigint"), F.col("rank").cast("bigint")).mapInArrow(run, schema)


# --- training -----------------------------------------------------------------


@dataclass(frozen=True)
class TreeTraining:
    """``learning_rate`` falls evenly to almost nothing over all rounds. Moves of a row that
    shards make along more than ``summed_uses`` uses in a round count less than their sum."""

    size: int = 128
    learning_rate: float = 0.025
    epochs: int = 2
    rounds: int = 2
    batch: int = 100
    seed: int = 42
    examples_per_shard: int = 100_000
    summed_uses: int = 5_000
    splits: int = 64


def step_gradients(
    centre: np.ndarray, nodes: np.ndarray, bits: np.ndarray, on: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Summed loss of a batch, and its gradients by centre (n, d) and by path node (n, l, d)."""
    score = (nodes @ centre[:, :, None])[:, :, 0]
    sign = 1 - 2 * bits  # bit 0 wants a high score
    loss = float((np.logaddexp(0, -sign * score) * on).sum())
    slope = -sign * on / (1 + np.exp(np.clip(sign * score, -30, 30)))
    return loss, (slope[:, None, :] @ nodes)[:, 0], slope[:, :, None] * centre[:, None, :]


def add_rows(table: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Add ``values`` to the rows ``at`` of the table, equal rows summed first."""
    order = np.argsort(at, kind="stable")
    rows = at[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    table[rows[first]] += np.add.reduceat(values[order], first, axis=0)


STEP_GROUP = 10


def true_step(vec: np.ndarray, centre: np.ndarray, nodes: np.ndarray, bits: np.ndarray, length: np.ndarray, rate: float) -> None:
    """One step of a batch along :func:`step_gradients`, with centres and padded path nodes as rows of ``vec``.

    Gradients are products of small matrices: of a group of examples, their distinct nodes, and the slopes
    between them. Examples should come from left to right in the tree: then few nodes are in several groups.
    """
    n, own = len(centre), np.arange(len(centre))
    groups = -(-n // STEP_GROUP)
    on = np.arange(nodes.shape[1]) < length[:, None]
    at, turn, example = nodes[on], bits[on], np.repeat(own, length)
    if not len(at):
        return
    pairs, pair = np.unique(example // STEP_GROUP * len(vec) + at, return_inverse=True)
    group, inner = pairs // len(vec), pairs % len(vec)
    column = np.arange(len(pairs)) - np.searchsorted(group, np.arange(groups))[group]
    width = column.max() + 1
    place = group * width + column
    # What is filled up is a centre's row: it gets no slope, and a node is no centre.
    wanted, ends = np.full(groups * width, centre[0]), np.full(groups * STEP_GROUP, centre[0])
    wanted[place], ends[:n] = inner, centre
    below, centres = vec[wanted], vec[ends].reshape(groups, STEP_GROUP, -1)
    beneath = below.reshape(groups, width, -1)
    cell = example * width + column[pair]
    sign = 1 - 2 * turn  # bit 0 wants a high score
    score = (centres @ beneath.transpose(0, 2, 1)).ravel()[cell]
    slope = -sign / (1 + np.exp(np.clip(sign * score, -30, 30)))
    slopes = np.bincount(cell, slope * rate, groups * STEP_GROUP * width).reshape(groups, STEP_GROUP, width)
    to_centres = (slopes @ beneath).reshape(groups * STEP_GROUP, -1)[:n]
    to_nodes = (slopes.transpose(0, 2, 1) @ centres).reshape(groups * width, -1)
    # A node of several groups moves by its sum, in each of its places.
    by = np.argsort(inner, kind="stable")
    new = np.concatenate([[True], inner[by][1:] != inner[by][:-1]])
    times = np.diff(np.flatnonzero(new), append=len(by))
    several = by[np.repeat(times > 1, times)]
    to_nodes[place[several]] = _one_sum(inner[several], to_nodes[place[several]])
    vec[wanted] = np.subtract(below, to_nodes, out=below)
    add_rows(vec, centre, -to_centres)


def _one_sum(names: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Each row replaced by the sum of the rows of its name."""
    kinds, of = np.unique(names, return_inverse=True)
    share = np.zeros((len(kinds), len(names)))
    share[of, np.arange(len(names))] = 1.0
    return (share @ values)[of]


def _example_table(pairs: DataFrame, ranks: DataFrame, t: TreeTraining) -> tuple[DataFrame, int]:
    """Examples (shard, uid, centre, context), tokens by rank, and the number of shards."""
    table = ranks.select("token", "rank", "n")
    counts = ranks.select("token", F.col("n").alias("_rows"))
    for column in ("context", "center"):
        own = table.select(F.col("token").alias(column), F.col("rank").alias(f"{column}_rank"), F.col("n").alias(f"{column}_n"))
        pairs = lookup(pairs, own, [column], spread="uid", how="inner", counts=counts.withColumnRenamed("token", column))
    pairs = stage(pairs.select("uid", "center_rank", "center_n", "context_rank"), "pairs")
    total = pairs.count()
    shards = max(1, -(-total // t.examples_per_shard))
    tokens = ranks.agg(F.sum("n")).first()[0] or 1
    # A centre has about n * total / tokens examples; one with many is split.
    parts = F.ceil(F.col("center_n") * F.lit(total / tokens) / t.examples_per_shard)
    part = F.pmod(F.xxhash64(F.lit("part"), "uid"), F.greatest(parts, F.lit(1)))
    shard = F.pmod(F.xxhash64("center_rank", part), F.lit(shards)).cast("int")
    return stage(pairs.select(shard.alias("shard"), "uid", F.col("center_rank").alias("centre"), F.col("context_rank").alias("context")), "examples"), shards


def _needed(examples: DataFrame, tree: Tree) -> DataFrame:
    """(shard, pid): the rows that each shard uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, context = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # Shard and node as one number: few distinct ones, as paths meet near the root.
            nodes, _, length = tree.paths(context)
            own = np.unique(np.repeat(shard.astype(np.int64), length) * tree.tokens + nodes[nodes >= 0])
            columns = [pa.array((own // tree.tokens).astype(np.int32)), pa.array(own % tree.tokens * 2 + 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "pid"])

    inner = examples.select("shard", "context").distinct().mapInArrow(run, "shard int, pid bigint")
    centres = examples.select("shard", (F.col("centre") * 2).alias("pid"))
    return stage(centres.unionByName(inner).distinct(), "needed")


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.float32).ravel()))


MOVES = "pid bigint, shard int, uses bigint, vec array<float>"


def _shard_moves(tree: Tree, t: TreeTraining, rate: float):
    def run(examples: pa.Table, rows: pa.Table) -> pa.Table:
        if not examples.num_rows or not rows.num_rows:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.float32()))], names=["pid", "shard", "uses", "vec"])
        order = np.lexsort((examples["uid"].to_numpy(), examples["mixed"].to_numpy()))
        pids = rows["pid"].to_numpy()
        by = np.argsort(pids)
        pids, start = pids[by], _matrix(rows["vec"], t.size)[by].astype(float)
        vec = start.copy()
        centre = np.searchsorted(pids, examples["centre"].to_numpy()[order] * 2)
        contexts, which = np.unique(examples["context"].to_numpy()[order], return_inverse=True)
        nodes, bits, length = tree.paths(contexts)
        nodes = np.searchsorted(pids, nodes * 2 + 1)
        uses = np.bincount(centre, minlength=len(pids))
        on = np.arange(nodes.shape[1]) < length[:, None]
        each = np.broadcast_to(np.bincount(which, minlength=len(contexts))[:, None], nodes.shape)
        uses += np.bincount(nodes[on], each[on], len(pids)).astype(np.int64)
        # From left to right in the tree within a batch, which is one step in any order.
        left = (bits * 0.5 ** np.arange(1, bits.shape[1] + 1)).sum(1)
        beside = np.lexsort((left[which], np.arange(len(which)) // t.batch))
        centre, which = centre[beside], which[beside]
        for low in range(0, len(order), t.batch):
            c, o = centre[low : low + t.batch], which[low : low + t.batch]
            true_step(vec, c, nodes[o], bits[o], length[o], rate)
        shard = np.full(len(pids), examples["shard"][0].as_py(), np.int32)
        return pa.table([pa.array(pids), pa.array(shard), pa.array(uses), _lists(vec - start)], names=["pid", "shard", "uses", "vec"])

    return run


def _summed(moves: DataFrame, keys: list[str], size: int, last: int | None) -> DataFrame:
    """Rows of ``moves`` summed by the keys, streamed in order. With ``last`` (uses up to which moves
    are summed), rows of shard -1 are the vectors that move, and the result is the new ones."""
    ordered = moves.repartition(*keys).sortWithinPartitions(*keys, "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            pid, part, shard, uses = (batch.column(i).to_numpy() for i in range(4))
            vec = _matrix(batch.column(4), size).astype(float)
            own = shard < 0
            # Per key: the vector, the sum of moves, uses, and how many shards moved it.
            wide = np.concatenate([np.where(own[:, None], vec, 0), np.where(own[:, None], 0, vec), uses[:, None], ~own[:, None]], axis=1)
            new = np.flatnonzero(np.concatenate([[True], (pid[1:] != pid[:-1]) | (part[1:] != part[:-1])]))
            sums = np.add.reduceat(wide, new, axis=0)
            names = np.stack([pid[new], part[new]], 1)
            if held is not None:
                if (names[0] == held[0][0]).all():
                    sums[0] += held[1][0]
                else:
                    names, sums = np.concatenate([held[0], names]), np.concatenate([held[1], sums])
            held = names[-1:], sums[-1:]
            if len(names) > 1:
                yield finished(names[:-1], sums[:-1])
        if held is not None:
            yield finished(*held)

    def finished(names: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        vec, moved, uses, shards = sums[:, :size], sums[:, size : 2 * size], sums[:, -2], np.maximum(sums[:, -1], 1)
        if last is None:
            columns = [pa.array(names[:, 0]), pa.array(np.zeros(len(names), np.int32)), pa.array(uses.astype(np.int64)), _lists(moved)]
            return pa.RecordBatch.from_arrays(columns, names=["pid", "shard", "uses", "vec"])
        share = np.maximum(1 / shards, np.minimum(1, last / np.maximum(uses, 1)))
        return pa.RecordBatch.from_arrays([pa.array(names[:, 0]), _lists(vec + share[:, None] * moved)], names=["pid", "vec"])

    schema = MOVES if last is None else "pid bigint, vec array<float>"
    return ordered.select("pid", "part", "shard", "uses", "vec").mapInArrow(run, schema)


def _moved(params: DataFrame, moves: DataFrame, shards: int, t: TreeTraining) -> DataFrame:
    part = F.lit(0).alias("part")
    if shards > 16 * t.splits:  # rows near the root are moved by every shard
        some = F.pmod(F.col("shard"), F.lit(t.splits)).alias("part")
        moves = _summed(moves.select("*", some), ["pid", "part"], t.size, None)
    own = params.select("pid", F.lit(-1).alias("shard"), F.lit(0).cast("bigint").alias("uses"), "vec")
    return stage(_summed(own.unionByName(moves).select("*", part), ["pid"], t.size, t.summed_uses), "parameters")


def initial_vectors(ranks: DataFrame, t: TreeTraining) -> DataFrame:
    """Tokens uniform within half a unit over the size; inner nodes, of which there is one less, zero."""
    places = F.sequence(F.lit(0), F.lit(t.size - 1))
    drawn = F.transform(places, lambda i: ((uniform(t.seed, "node", F.col("rank"), i) - 0.5) / t.size).cast("float"))
    tokens = ranks.select((F.col("rank") * 2).alias("pid"), drawn.alias("vec"))
    inner = ranks.where("rank > 0").select((F.col("rank") * 2 - 1).alias("pid"), F.array_repeat(F.lit(0.0).cast("float"), t.size).alias("vec"))
    return stage(tokens.unionByName(inner), "parameters")


def trained_tree_vectors(pairs: DataFrame, ranks: DataFrame, t: TreeTraining) -> DataFrame:
    """Token vectors (token, vector) after training on pairs (uid, center, context).

    ``ranks`` is (token, n, rank). Pairs with a token outside it take no part. The result
    is the same for any partitioning; an empty vocabulary gives no rows, and
    a token without pairs keeps its first vector.
    """
    tree = tree_of(ranks)
    params = initial_vectors(ranks, t)
    examples, shards = _example_table(pairs, ranks, t)
    needed = _needed(examples, tree)
    rounds = min(t.rounds, shards)
    for number in range(t.epochs * rounds):
        rate = t.learning_rate * max(1e-4, 1 - number / (t.epochs * rounds))
        now = F.pmod(F.col("shard"), F.lit(rounds)) == number % rounds
        mixed = F.xxhash64(F.lit(t.seed), F.lit(number), "uid").alias("mixed")
        own = examples.where(now).select("shard", F.xxhash64("uid").alias("uid"), mixed, "centre", "context")
        rows = lookup(needed.where(now), params, ["pid"], spread="shard", how="inner").toDF("for_shard", "pid", "vec")
        moves = own.groupBy("shard").cogroup(rows.groupBy("for_shard")).applyInArrow(_shard_moves(tree, t, rate), MOVES)
        params = _moved(params, moves, shards, t)
    tokens = params.where(F.col("pid") % 2 == 0).withColumn("rank", F.floor(F.col("pid") / 2))
    return tokens.join(ranks, "rank").select("token", F.col("vec").cast("array<double>").alias("vector"))

