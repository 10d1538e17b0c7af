from dataclasses import replace
import random

import numpy as np
from conftest import rows

from walkvec.config import Config
from walkvec.operators.train import Training
from walkvec.plans import jobs
from walkvec.sources import readers


def test_audience_job(spark, tmp_path):
    rng = random.Random(2)
    lines = [
        f'"m{m:02d}" i{(m % 2) * 6 + rng.randrange(6)} {rng.randint(1, 5)} 1' for m in range(24) for _ in range(6)
    ]
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "20200101").write_text("\n".join(lines))
    base = [(f"m{m:02d}", "124000000010", "60q" if m < 12 else "05h", "20200101") for m in range(24)]
    spark.createDataFrame(
        base, "memb_id string, gender_cd string, age_group string, statis_date string"
    ).write.partitionBy("statis_date").format("parquet").saveAsTable("job_base")
    cfg = Config(walks_per_node=3, walk_steps=4, vector_size=4, window=2, neighbours_out=3)
    out = str(tmp_path / "out")
    cfg = replace(cfg, lsh_threshold=1.0, lsh_tables=12, lsh_hashes_per_table=2)
    jobs.run_audience_job(
        spark, str(tmp_path / "log"), "job_base", "20200101", out, cfg, "job_result", "job_pairs"
    )
    nodes = readers.read_node_index(spark, f"{out}/nodes")
    assert nodes.groupBy("seg_id").count().count() == 2 and nodes.count() == 24
    walked = readers.read_walks(spark, f"{out}/walks")
    assert walked.count() == 72 and {r.seg_id for r in walked.collect()} == {0, 6}
    named = readers.read_embeddings(spark, f"{out}/embeddings")
    assert named.count() == 24
    result = spark.table("job_result")
    assert 0 < result.count() <= 72 and result.where("user1 = user2").count() == 0
    vectors = {r.member_id: (r.seg_id, np.array(r.vector)) for r in named.collect()}
    rep = {r.id: r.rep for r in spark.read.parquet(f"{out}/copies").collect()}
    stored = {(r.user1, r.user2) for r in spark.table("job_pairs").collect()}
    assert set(rep) == set(vectors) and {m for p in stored for m in p} <= set(rep.values())
    pairs = {
        (a, b)
        for a in vectors
        for b in vectors
        if a != b and vectors[a][0] == vectors[b][0] and (rep[a] == rep[b] or (rep[a], rep[b]) in stored)
    }
    near = {
        (a, b)
        for a, (s, x) in vectors.items()
        for b, (t, y) in vectors.items()
        if a != b and s == t and np.linalg.norm(x - y) < 1.0
    }
    assert pairs <= near and len(pairs) >= 0.9 * len(near)
    spark.sql("DROP TABLE job_pairs")
    spark.sql("DROP TABLE job_base")
    spark.sql("DROP TABLE job_result")


def test_item_jobs(spark, tmp_path):
    side = tmp_path / "side"
    side.write_text("\n".join(f"{i} g{i} n{i % 3} a{i % 2} b c brand{i % 2} s{i % 2} x|y{i % 2}" for i in range(8)))
    seq = tmp_path / "seq"
    seq.mkdir()
    (seq / "part").write_text("\n".join("0 2 4 6 0 2" if i % 2 else "1 3 5 7" for i in range(10)) + "\n9\n")
    t = Training(size=8, epochs=1, batch=10, learning_rate=1.0)
    model = str(tmp_path / "model")
    jobs.train_items(spark, str(side), str(seq), model, t, window=2)
    jobs.export_known(spark, str(side), model, str(tmp_path / "known"), 8)
    known = spark.read.parquet(str(tmp_path / "known"))
    assert {r.item_key for r in known.collect()} == {f"g{i}_s{i % 2}" for i in range(8)}
    new = tmp_path / "new"
    new.write_text("50 gnew nnew a0 b c brand1 s1 x\n51 gnew nnew a0 b c other s1 x\n")
    jobs.export_cold(spark, str(new), model, str(tmp_path / "cold"), 8, 8)
    cold = spark.read.parquet(str(tmp_path / "cold")).collect()
    assert [r.item_key for r in cold] == ["gnew_s1"]
    assert abs(sum(x * x for x in cold[0].vector) - 1) < 1e-9


def test_recommendation_job(spark, tmp_path):
    (tmp_path / "rec_0").write_text("a\tb\t0.5\n")
    (tmp_path / "rec_3").write_text("c\td\t0.5\n")
    for _ in range(2):
        jobs.load_recommendations(spark, str(tmp_path), "rec_result", "20200101")
    assert rows(spark.table("rec_result"), "user1", "user2", "dt") == [("a", "b", "20200101"), ("c", "d", "20200101")]
    spark.sql("DROP TABLE rec_result")
