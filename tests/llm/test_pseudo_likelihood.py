import numpy as np
from cases import blank_words, documents
from pyspark.sql import functions as F

from walkvec.llm import pseudo_likelihood as p
from walkvec.llm.textnum import Chunk
from walkvec.stage import stage_path

DATA = "/root/testdata/sf0.01"


def test_gradient_is_the_slope(monkeypatch):
    rng = np.random.default_rng(1)
    model = p.start(rng.integers(0, 50, p.VOCABULARY).astype(float))
    model = {k: v.astype(np.float64) for k, v in model.items()}
    ids, places, n = p._padded([rng.integers(0, p.VOCABULARY, 30).astype(np.int16).tobytes(), b"", rng.integers(0, 40, 9).astype(np.int16).tobytes()])
    assert n.tolist() == [30, 0, 9]
    gradient = {k: np.zeros(v.shape) for k, v in model.items()}
    p.log_probabilities(model, ids, places, gradient)
    for name in model:
        flat = gradient[name].ravel()
        for at in np.argsort(-np.abs(flat))[:3]:
            values = []
            for h in (1e-4, -1e-4):
                moved = {k: v.copy() for k, v in model.items()}
                moved[name].ravel()[at] += h
                values.append(p.log_probabilities(moved, ids, places).sum())
            assert abs((values[0] - values[1]) / 2e-4 - flat[at]) < 1e-3 * max(1, abs(flat[at]))


def test_probabilities_sum_to_one():
    model = p.start(np.ones(p.VOCABULARY))
    total = 0.0
    for word in range(p.VOCABULARY):
        ids = np.array([p._PAD, p._PAD, 5, word, 9, p._PAD, p._PAD], np.int16)
        total += np.exp(p.log_probabilities(model, ids, np.array([3]))[0])
    assert abs(total - 1) < 1e-3


def test_training_beats_word_frequencies(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = p.word_counts(docs)
    top = p.vocabulary(counts)
    assert len(top) == p.VOCABULARY - p.SHARED
    frequency = p.entry_counts(counts, top)
    assert frequency.sum() == counts.agg(F.sum("n")).first()[0]
    path = stage_path(spark, "encoded")
    p.encoded(docs, top).write.partitionBy("round").parquet(path)
    model, means = p.train(path, spark, frequency)
    assert len(means) == p.ROUNDS
    rows = spark.read.parquet(path)
    sums = {}
    for name, m in (("plain", {**model, **{k: v for k, v in p.start(frequency).items()}}), ("trained", model)):
        r = p.scores(rows, m).agg(F.sum("log_likelihood"), F.sum("n_tokens")).first()
        sums[name] = r[0] / r[1]
    assert sums["trained"] > sums["plain"] + 0.1, sums


def test_layout_does_not_change_the_gradient(spark):
    docs = documents(spark)
    top = p.vocabulary(p.word_counts(docs))
    rows = p.encoded(docs, top, 1)
    model = p.start(np.ones(p.VOCABULARY))
    one, several = (p.round_gradient(rows.repartition(k), model) for k in (1, 5))
    assert one[2] == several[2] and abs(one[1] - several[1]) < 1e-3
    assert np.allclose(one[0], several[0], atol=1e-3)


def test_awkward_documents(spark):
    docs = documents(spark)
    got = p.scored_documents(docs, rounds=2).collect()
    assert len(got) == docs.count()
    want = sorted((str(r["doc_id"]), len(blank_words(r["text"]))) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == want
    for r in got:
        assert (r["log_likelihood"] == 0 and r["mean_log_likelihood"] is None) if not r["n_tokens"] else r["log_likelihood"] < 0
    equal = [r["log_likelihood"] for r in got if r["doc_id"] in (89, 88) and r["n_tokens"] == 90]
    assert len(set(equal)) == 1
    assert p.scored_documents(docs.limit(0), rounds=2).count() == 0


def _sharing(spark, docs):
    """Frequencies by entry, hashes of the words in shared entries, and occurrences by hash."""
    counts = p.word_counts(docs)
    top = p.vocabulary(counts)
    n = {r["word"]: r["n"] for r in counts.collect()}
    rare = np.array(sorted(set(n) - set(top.view(np.int64).tolist())), np.int64)
    return top, p.entry_counts(counts, top), rare, n


def test_words_of_an_entry_have_their_own_probabilities(spark):
    """Texts that differ by one word, in one shared entry: the scores differ by the words' log ratio."""
    base = [" ".join(f"top{i}" for i in range(p.VOCABULARY - p.SHARED))] * 40
    names = [f"rare{i}" for i in range(4000)]
    entries = {}
    for name in names:
        data = np.frombuffer(name.encode(), np.uint8)
        h = p.words(Chunk(0, data, np.array([0, len(data)]))).hashes
        entries.setdefault(int(h[0] % p.U(p.SHARED)), []).append(name)
    often, once = next(v for v in entries.values() if len(v) > 1)[:2]
    base += [" ".join([often] * 30)] + [f"top1 top2 {w} top3 top4" for w in (often, once)]
    docs = spark.createDataFrame(list(enumerate(base)), "doc_id long, text string")
    got = {r["doc_id"]: r["log_likelihood"] for r in p.scored_documents(docs, rounds=2).collect()}
    assert abs(got[41] - got[42] - np.log(31)) < 0.01


def test_shares_of_every_entry_sum_to_one(spark):
    """Blocks of any size give each word the same share, and the shares of an entry sum to 1."""
    docs = documents(spark)
    top, frequency, rare, n = _sharing(spark, docs)
    entry = p.VOCABULARY - p.SHARED + (rare.view(p.U) % p.U(p.SHARED)).astype(np.int64)
    sums = np.bincount(entry, [n[w] for w in rare.tolist()], p.VOCABULARY)
    assert np.array_equal(sums[-p.SHARED :], frequency[-p.SHARED :])
    counts = p.word_counts(docs)
    model = p.start(frequency)
    results = []
    for block_words in (50, 1 << 21):
        path = stage_path(spark, "encoded")
        p.encoded(docs, top, 2, block_words).write.parquet(path)
        rows = spark.read.parquet(path)
        plain = p.scores(rows, model, frequency, ("block", "rare"))
        own = p.with_own_shares(plain, p.listed_counts(rows, counts))
        results.append(sorted((str(r[0]), r[1], round(r[2], 3)) for r in own.collect()))
        plain_rows = {(str(r["doc_id"]), r["n_tokens"]) for r in plain.collect()}
        assert plain_rows == {r[:2] for r in results[-1]}
    assert results[0] == results[1]
