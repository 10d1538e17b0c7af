import zlib
from itertools import product

from cases import documents
from pyspark.sql import functions as F

from walkvec.llm.sharding import hilbert_index, hilbert_shards


def test_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (1, 3)):
        cells = list(product(range(1 << bits), repeat=n))
        df = spark.createDataFrame(cells, [f"c{i}" for i in range(n)])
        at = df.select("*", hilbert_index([F.col(f"c{i}") for i in range(n)], bits).alias("h")).collect()
        order = {r["h"]: tuple(r)[:n] for r in at}
        assert sorted(order) == list(range(len(cells)))
        steps = [sum(abs(a - b) for a, b in zip(order[i], order[i + 1])) for i in range(len(cells) - 1)]
        assert set(steps) <= {1}


def test_shards_have_equal_counts(spark):
    docs = documents(spark)
    for shards in (24, 7):
        rows = hilbert_shards(docs, shards).collect()
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
            assert r["law"] == "rows" and r["grown_shard"] is None
        counts = [len(v) for v in slots.values()]
        assert max(counts) - min(counts) <= 1 and sorted(slots) == list(range(shards))
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        got = sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows)
        want = sorted(
            (str(r["doc_id"]), len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
            for r in docs.collect()
        )
        assert got == want
        curve = [(r["shard"], r["slot"], r["curve"]) for r in rows]
        assert [c[2] for c in sorted(curve)] == sorted(c[2] for c in curve)


def test_fewer_rows_than_shards_and_none(spark):
    docs = documents(spark).limit(5)
    assert sorted(r["slot"] for r in hilbert_shards(docs).collect()) == [0] * 5
    assert hilbert_shards(docs.limit(0)).count() == 0
