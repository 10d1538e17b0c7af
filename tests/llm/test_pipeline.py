import corpus_pipeline
from cases import blank_words

from walkvec.llm import decontaminate, mixing, quality_model, queries, shingle_join

DATA = "/root/testdata/sf0.001"


def test_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert set(queries.statements()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "hilbert_sharding"


def test_stages_take_effect_in_order(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}

    good = {r["doc_id"] for r in quality_model.scored_documents(docs, labels).collect() if r["predicted"]}
    left = docs.where(docs.doc_id.isin(list(good)))
    groups = {r["component_id"] for r in shingle_join.near_duplicates(left).collect()}
    left = docs.where(docs.doc_id.isin(list(groups)))
    clean = {r["doc_id"] for r in decontaminate.decontaminate(left, items).collect() if not r["contaminated"]}
    left = docs.where(docs.doc_id.isin(list(clean)))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed_documents(left).collect()}

    rows = corpus_pipeline.run(spark, DATA).collect()
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert r["size"] == len(text[r["doc_id"]].encode()) + 8
    assert got == {i: n for i, n in copies.items() if n}
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(blank_words(text[i]) for i in good)
