import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from walkvec.operators import sequences, train
from walkvec.plans import audience
from walkvec.config import Config


def _communities(spark, walks=300, length=8):
    """Walks that stay within one of two groups of ten tokens."""
    rng = random.Random(11)
    data = []
    for i in range(walks):
        group = i % 2
        data.append((0, f"0|w|{i}", [group * 10 + rng.randrange(10) for _ in range(length)]))
    return spark.createDataFrame(data, "seg_id int, walk_id string, nodes array<bigint>")


def _contrast(vectors):
    v = {r.node_id: np.array(r.vector) for r in vectors}
    assert set(v) == set(range(20))
    unit = {k: x / np.linalg.norm(x) for k, x in v.items()}
    same = [unit[a] @ unit[b] for a in v for b in v if a < b and a // 10 == b // 10]
    other = [unit[a] @ unit[b] for a in v for b in v if a < b and a // 10 != b // 10]
    return float(np.mean(same) - np.mean(other))


def test_communities_separate(spark):
    cfg = Config(vector_size=8, window=3, iterations=4)
    got = audience.node_vectors(_communities(spark), cfg).collect()
    assert _contrast(got) > 0.3


def test_no_words_gives_an_empty_result(spark):
    df = spark.createDataFrame([], "seg_id int, walk_id string, nodes array<bigint>")
    assert audience.node_vectors(df, Config()).collect() == []


def test_shards_are_only_layout(spark):
    tokens = sequences.array_positions(
        _communities(spark, 30).select(F.col("walk_id").alias("seq_id"), F.col("nodes").alias("tokens"))
    )
    ranks = sequences.token_ranks(tokens).persist()
    uid = F.concat_ws("|", "seq_id", "center_pos", "context_pos").alias("uid")
    pairs = sequences.skipgram_pairs(tokens, 2).select(uid, "center", "context")
    got = []
    for per_shard in (10_000, 60):
        t = train.Training(size=4, rounds=2, examples_per_shard=per_shard)
        rows = train.trained_word_vectors(pairs, ranks, t).collect()
        got.append({r.token: np.array(r.vector) for r in rows})
    assert set(got[0]) == set(got[1]) == set(range(20))
    assert all(np.allclose(got[0][k], got[1][k], atol=1e-9) for k in got[0])


def _shard(t, weighted=True, rng=np.random.default_rng(0)):
    """Two examples with side rows, attention rows, and three context rows."""
    att = [train.TABLES.index("attention")] if weighted else []
    refs = [[0, 16 + 2, 7, 16 + 7, *att], [0, 32 + 2, 7, *att]]
    outs = [[9, 16 + 9], [16 + 9, 32 + 9]]
    examples = pd.DataFrame({"uid": ["a", "b"], "refs": refs, "outs": outs, "vocab": [3, 3]})
    pids = sorted({p for r in refs + outs for p in r})
    width = {8: 8, 9: t.size + 1}
    vec = [rng.normal(size=width.get(p % 16, t.size)) for p in pids]
    return train._Shard(examples, pd.DataFrame({"pid": pids, "vec": vec}), t)


@pytest.mark.parametrize("weighted", [True, False])
def test_gradient(weighted):
    t = train.Training(size=4, negatives=1, learning_rate=1e-3)
    shard = _shard(t, weighted)
    start = shard.vec.copy()
    shard.step(0, 2, learn=True)
    assert (shard.vec == start).all()
    moved = shard.gradient / 2
    used = {p: sum(list(r).count(p) for r in shard.outs) for p in range(len(start)) if shard.is_context[p]}
    assert all(shard.uses[p] == n for p, n in used.items())
    widths = shard.widths()
    for i in range(len(start)):
        for j in range(widths[i]):
            loss = []
            for eps in (1e-6, -1e-6):
                shard.vec = start.copy()
                shard.vec[i, j] += eps
                loss.append(shard.step(0, 2, learn=False) / 2)
            assert moved[i, j] == pytest.approx((loss[0] - loss[1]) / 2e-6, abs=1e-5)


def test_loss_falls_and_shards_agree_on_the_rows(spark):
    tokens = sequences.array_positions(
        _communities(spark, 60).select(F.col("walk_id").alias("seq_id"), F.col("nodes").alias("tokens"))
    )
    encoded = spark.createDataFrame(
        [(f"k{i}", i, i, i % 4, i // 10, 0, 0, i % 3, i % 5, [i // 10, 2]) for i in range(20)],
        "item_key string, node bigint, gds_idx bigint, gen_gds_idx bigint, l4_idx bigint, l3_idx bigint,"
        "l2_idx bigint, big_brand_idx bigint, shop_idx bigint, sal_idx array<bigint>",
    )
    t = train.Training(size=8, epochs=2, rounds=3, batch=20, examples_per_shard=200)
    fit = audience.train_side_vectors(tokens, encoded, 2, t)
    assert fit.examples.select("shard").distinct().count() > 1
    before = train.evaluate(fit.examples, fit.ranks, fit.initial, t).first()
    after = train.evaluate(fit.examples, fit.ranks, fit.params, t).first()
    assert before.examples == after.examples == fit.examples.count()
    assert after.mean_loss < before.mean_loss
    assert fit.params.count() == fit.initial.count()
    sizes = fit.params.select((F.col("pid") % 16).alias("t"), F.size("vec").alias("n")).distinct().collect()
    assert {(r.t, r.n) for r in sizes} == {(c, 8) for c in range(8)} | {(8, 8), (9, 9)}


def test_hot_parameter_rows(spark, monkeypatch):
    """A row that every shard needs takes the broadcast way and gives the same changes."""
    examples = spark.createDataFrame(
        [(i, f"u{i}", [0, 16 * (i % 5) + 2], [9, 25], 3) for i in range(40)],
        "shard int, uid string, refs array<bigint>, outs array<bigint>, vocab bigint",
    )
    params = spark.createDataFrame(
        [(p, [float(p)]) for p in (0, 2, 18, 34, 50, 66, 9, 25)], "pid bigint, vec array<double>"
    )
    plain = sorted(map(tuple, train._shard_rows(examples, params).select("for_shard", "pid").collect()))
    from walkvec.operators import skew

    monkeypatch.setattr(train, "lookup", lambda *a, **k: skew.lookup(*a, hot_rows=5, **k))
    hot = sorted(map(tuple, train._shard_rows(examples, params).select("for_shard", "pid").collect()))
    assert plain == hot and len(hot) == 160


def test_a_round_over_cells_equals_the_plain_form(spark):
    """Also with a token that is no item, one that is two, and one without a rank."""
    data = [(s, p, [3, 1, 4, 1, 5, 9, 2, 6][(p + s) % 8]) for s in range(6) for p in range(7)] + [(9, 0, None), (9, 1, 3), (9, 2, 4)]
    tokens = spark.createDataFrame(data, "seq_id bigint, pos bigint, token bigint")
    ranks = sequences.token_ranks(tokens.where("token <> 9")).persist()
    items = [(1, [0, 2, 8 + 16]), (2, [16, 2, 18, 8 + 32]), (3, [0, 18]), (4, [32, 8 + 64]), (4, [48, 2]), (5, [0, 2, 2])]
    references = spark.createDataFrame(items, "center bigint, refs array<bigint>")
    t = train.Training(size=3, negatives=2, rounds=2, batch=2, examples_per_shard=10, items_per_shard=2)
    params = train.initial_parameters(references, ranks, t)
    examples = train.sequence_examples(tokens, references, ranks, 2, t)
    uid = F.concat_ws("|", "seq_id", "center_pos", "context_pos").alias("uid")
    pairs = sequences.skipgram_pairs(tokens, 2).select(uid, "center", "context")
    of_pairs = train.prepare_examples(pairs, references, ranks, t)
    count = pairs.where("context <> 9 AND center NOT IN (6, 9)").count() + pairs.where("context <> 9 AND center = 4").count()
    assert examples.count() == of_pairs.count() == count

    outs = F.concat(F.array("context"), F.transform(F.sequence(F.lit(1), F.lit(2)), lambda j: sequences.log_uniform_rank(
        train.uniform(t.seed, "neg", F.col("epoch"), F.col("uid"), j), F.lit(ranks.count()))))
    rows = pd.DataFrame({"pid": [], "vec": []})
    for epoch in (0, -1):
        drawn = examples.rows.withColumn("epoch", F.lit(str(epoch)))
        drawn = drawn.where(train.round_of(t, 0) == 0) if epoch == 0 else drawn
        drawn = drawn.join(examples.items, "item").select("uid", "refs", F.transform(outs, lambda r: train.pid("context", r)).alias("outs"))
        rows = params.toPandas()
        shard = train._Shard(drawn.toPandas().assign(vocab=ranks.count()), rows, t)
        loss = shard.step(0, len(shard), learn=True)
        if epoch == 0:
            rate = np.minimum(t.learning_rate, t.most_step / np.maximum(shard.uses, 1))
            want = dict(zip(shard.pids, shard.vec - rate[:, None] * shard.gradient))
            for some in (examples, of_pairs):
                got = train.first_round(some, ranks, params, t).collect()
                assert len(got) == len(want)
                assert all(np.allclose(r.vec, want[r.pid][: len(r.vec)], atol=1e-12) for r in got)
        else:
            row = train.evaluate(examples, ranks, params, t).first()
            assert row.examples == count and row.mean_loss == pytest.approx(loss / count)


def test_starting_values_equal_the_expressions(spark):
    references = spark.createDataFrame([(1, [0, 18, 8]), (2, [16, 8])], "center bigint, refs array<bigint>")
    ranks = spark.createDataFrame([("a", 5, 0), ("b", 2, 1)], "token string, n bigint, rank bigint")
    t = train.Training(size=12)
    code, row, context = F.col("pid") % 16, F.floor(F.col("pid") / 16), F.lit("context")

    def uniforms(size):
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: train.uniform(t.seed, code, row, i) * 2.0 - 1.0)

    def normal(i):
        u, turn = (train.uniform(t.seed, context, F.col("rank"), i, end) for end in "ab")
        z = F.sqrt(F.log(1.0 - u) * -2.0) * F.cos(turn * (2.0 * np.pi))
        return F.greatest(F.least(z, F.lit(2.0)), F.lit(-2.0)) * (1.0 / np.sqrt(t.size))

    used = references.select(F.explode("refs").alias("pid")).distinct()
    want = {r.pid: r.vec for r in used.select("pid", F.when(code == 8, uniforms(len(train.SLOTS))).otherwise(uniforms(12)).alias("vec")).collect()}
    drawn = ranks.select("rank", F.transform(F.sequence(F.lit(0), F.lit(11)), normal).alias("vec")).collect()
    want |= {r.rank * 16 + 9: [*r.vec, 0.0] for r in drawn}
    assert {r.pid: r.vec for r in train.initial_parameters(references, ranks, t).collect()} == want


def test_only_the_given_and_the_last_parameters_stay(spark):
    """Tables of a round go with it, so that the disk holds two sets of parameters however many rounds there are."""
    tokens = spark.createDataFrame([(s, p, (s + p) % 5) for s in range(4) for p in range(6)], "seq_id bigint, pos bigint, token bigint")
    ranks = sequences.token_ranks(tokens).persist()
    t = train.Training(size=3, negatives=2, epochs=2, rounds=2)
    references = train.node_references(ranks)
    params = train.initial_parameters(references, ranks, t)
    examples = train.sequence_examples(tokens, references, ranks, 2, t)
    root = Path(params.inputFiles()[0].removeprefix("file:")).parent.parent
    before = {p.name for p in root.iterdir()}
    trained = train.train(examples, ranks, params, t)
    assert [p.rsplit("-")[0] for p in {p.name for p in root.iterdir()} - before] == ["parameters"]
    assert trained.count() == params.count() > 0


def test_cells_for_all_tasks():
    t = train.Training()
    assert [train._blocks(n, t) for n in (0, 10, 1_000_001)] == [1, 1, 2]
    assert [train._blocks(n, t, 6) for n in (0, 10, 100_000, 1_110_000, 400_000_000)] == [1, 1, 2, 4, 20]
