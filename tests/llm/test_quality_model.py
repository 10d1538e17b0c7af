import zlib

import numpy as np
from cases import documents
from pyspark.sql import functions as F

from walkvec.llm import quality_model as m

DATA = "/root/testdata/sf0.01"


def test_flat_trees_equal_a_walk_node_by_node():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 6)).astype(np.float32)
    x[:, 2] = np.round(x[:, 2])  # ties
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0)).astype(float)
    model = m.fit(x, y, trees=15, depth=3)
    want = []
    for row in x:
        margin = model.base
        for t in range(15):
            i = 0
            while i < model.feature.shape[1]:
                i = 2 * i + (2 if row[model.feature[t, i]] > model.threshold[t, i] else 1)
            margin += model.value[t, i - model.feature.shape[1]]
        want.append(1 / (1 + np.exp(-margin)))
    assert np.allclose(m.predict(model, x), want)
    assert ((m.predict(model, x) > 0.5) == y).mean() > 0.95


def test_constant_without_contrast():
    x = np.zeros((4, 3), np.float32)
    assert np.allclose(m.predict(m.fit(x[:0], np.zeros(0)), x), 0.5)
    assert (m.predict(m.fit(x, np.ones(4)), x) > 0.8).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = m.scored_documents(docs, labels).join(labels, "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows} == {True}
    assert np.mean([r["predicted"] == r["quality"] for r in out]) >= 0.95
    good = [r["score"] for r in out if r["quality"] == 1]
    poor = [r["score"] for r in out if r["quality"] == 0]
    above = np.mean([[(g > p) + 0.5 * (g == p) for p in poor] for g in good])
    assert above >= 0.95


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs = documents(spark)
    labels = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).distinct()
    turned = labels.withColumn("quality", F.when(m.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(str, m.scored_documents(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_awkward_documents(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (None, 1, 0), (7, None, 1)], "doc_id bigint, quality int, toxic int")
    rows = m.scored_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["predicted"] == (r["score"] >= 0.3) for r in rows} == {True}
    assert m.scored_documents(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in m.scored_documents(docs, labels.limit(0)).collect()} == {0.5}
    good = m.good_documents(docs, labels.limit(0))
    assert good.columns == docs.columns and good.count() == docs.count()
