import random

import numpy as np
import pyarrow as pa
import pytest
from cases import bag, blank_words, documents, lower, pairs, prose

from walkvec.llm import common, shingle_join
from walkvec.llm.shingle_join import forest, near_duplicates, one_of_each, shared_by
from walkvec.stage import stage


def shingles(text):
    w = blank_words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = root(i)
            least[r] = min(doc_id, least.get(r, doc_id))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)], root


def compare(docs):
    want, _ = brute(pairs(docs))
    got = bag(near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    assert sorted(got.elements(), key=str) == sorted(want, key=str)


def test_awkward_documents(spark):
    compare(documents(spark))


@pytest.mark.parametrize("frequent,block,most_light", [(3, 4, 24), (1000, 256, 24), (3, 4, 0)])
def test_groups_of_any_size(spark, monkeypatch, frequent, block, most_light):
    monkeypatch.setattr(shingle_join, "FREQUENT", frequent)
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "MOST_LIGHT", most_light)
    rng = random.Random(frequent)
    rows = []
    for group in range(6):
        base = prose(rng, (9, 12, 17, 60, 100, 140)[group], 3000).split()
        for i in range((4, 8, 12, 25, 30, 9)[group]):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(50)}"
            rows.append((" ".join(copy[: len(copy) - rng.randrange(3)])))
    boiler = prose(rng, 40, 9000)
    rows += [prose(rng, rng.randrange(5, 120)) + " " + boiler for _ in range(25)]
    rng.shuffle(rows)
    compare(documents(spark, [(i * 3, t, "en", "a") for i, t in enumerate(rows)]))


def test_forest_finds_all_links_of_a_cell():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(60, rng.integers(5, 50), replace=False)) for _ in range(40)]
    sets += [np.sort(np.unique(np.append(s[1:], 100 + i))) for i, s in enumerate(sets[:15])]
    links = forest(np.arange(len(sets)), sets, 60)
    groups = list(range(len(sets)))

    def root(i):
        while groups[i] != i:
            i = groups[i]
        return i

    for a, b in links:
        common = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * common >= 60 * (len(sets[a]) + len(sets[b]) - common)
        assert root(a) != root(b)
        groups[root(a)] = root(b)
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 60 * (len(sets[a]) + len(sets[b]) - common):
                assert root(a) == root(b)


def test_shared_elements():
    for size in range(1, 60):
        need = shared_by(size, 80)
        assert 100 * need >= 80 * size and 100 * (need - 1) < 80 * size


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    rows = pairs(docs)
    _, root = brute(rows)
    got = one_of_each(docs)
    assert got.columns == docs.columns
    kept = pairs(got)
    full = {root(i) for i, (_, t) in enumerate(rows) if blank_words(t)}
    with_words = [(d, t) for d, t in kept if blank_words(t)]
    assert len(with_words) == len(full)
    assert len([1 for _, t in kept if not blank_words(t)]) == len([1 for _, t in rows if not blank_words(t)])
    chosen = [root(rows.index(k)) for k in with_words]
    assert len(set(chosen)) == len(chosen)


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert near_duplicates(docs).count() == 0 and one_of_each(docs).count() == 0


def test_python_steps_take_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), []

    def recorded(df, label="stage"):
        seen.append(int(spark.conf.get(key)))
        return stage(df, label)

    monkeypatch.setattr(shingle_join, "stage", recorded)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in shingle_join.one_of_each(docs).collect()) == [1, 3]
    # Before, a batch had 10,000 whole texts or sets, on both sides of each task's pipe.
    assert sum(n == common.BATCH_ROWS for n in seen) >= len(seen) - 1
    assert spark.conf.get(key) == before


def test_batches_in_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array([[i] * i for i in range(7)])], names=["n", "l"])
    parts = list(common.pieces(iter([batch, batch.slice(0, 0), batch.slice(2, 4)]), 3))
    assert [p.num_rows for p in parts] == [3, 3, 1, 3, 1]
    assert [n for p in parts for n in p.column("n").to_pylist()] == [*range(7), *range(2, 6)]
