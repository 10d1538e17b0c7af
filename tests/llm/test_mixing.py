from collections import defaultdict

from cases import blank_words, documents

from walkvec.llm import mixing


def fill(sizes, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] <= weight[s] * unit}
        if not full:
            target.update({s: weight[s] * unit for s in open_})
            break
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def check(docs, slack):
    rows = [r.asDict() for r in mixing.mixed_documents(docs).collect()]
    source = defaultdict(int)
    for r in docs.select("source", "text").collect():
        source[r["source"]] += len(blank_words(r["text"]))
    want = fill(dict(source))
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == source[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, target in want.items():
        assert abs(taken[s] - target) <= slack(s, target)
    return sorted((str(r) for r in rows))


def test_targets_and_words_taken(spark):
    docs = documents(spark)
    biggest = 6_000
    first = check(docs, lambda s, t: biggest)  # one text holds most of the words
    assert first == check(docs.repartition(3), lambda s, t: biggest)


def test_many_documents_come_near(spark):
    rows = [(i, "w " * (1 + (i * 7919) % 97), "en", "abcab"[i % 5]) for i in range(600)]
    check(documents(spark, rows), lambda s, t: 0.005 * t + 2)


def test_full_sources_and_no_words(spark):
    rows = [(1, "a b c", "en", "a"), (2, "a " * 500, "en", "b"), (3, None, "en", "c")]
    got = {r["doc_id"]: r for r in mixing.mixed_documents(documents(spark, rows)).collect()}
    assert got[1]["taken"] in (3, 6, 9) and got[1]["target"] == 9.0 and got[1]["taken"] == 9
    assert got[3]["target"] == 0.0 and got[3]["taken"] == 0
    assert mixing.mixed_documents(documents(spark).limit(0)).count() == 0


def test_corpus_repeats_rows_as_often_as_taken(spark):
    docs = documents(spark)
    plan = {(r["doc_id"], r["size"], r["source"]): r["copies"] for r in mixing.mixed_documents(docs).collect()}
    got = mixing.mixed_corpus(docs)
    assert got.columns == docs.columns
    want = sum(plan[(r["doc_id"], len(blank_words(r["text"])), r["source"])] for r in docs.collect())
    assert got.count() == want
