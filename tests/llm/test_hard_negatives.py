import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import bag
from collections import Counter

from walkvec.llm import hard_negatives as H

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, length string, bucket string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def plain(rows):
    """The contract in plain Python, for rows (vec_id, embedding, label) before labels are shifted."""
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for i, v, label in kept:
        if i is None or i % 100:
            continue
        same = sorted(((score(v, w), j) for j, w, m in kept if m == label and j != i), key=order)[:5]
        other = sorted(((score(v, w), j) for j, w, m in kept if m != label), key=order)
        for s, j in same:
            near = [x for x in other if 80 * s <= 100 * x[0] <= 100 * s][:5]
            out += [(i, j, k + 1, x[1], s, x[0]) for k, x in enumerate(near)]
    return out


def cases(seed=1, n=420):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, 6))
    rows = []
    for i in range(n):
        label = int(rng.integers(10))
        v = centres[label] + rng.normal(size=6) * 0.7
        v = v / np.linalg.norm(v) * (1 if i % 3 else float(rng.uniform(0.1, 4)))
        rows.append((i, v.tolist(), label))
    rows += [rows[100], rows[100], rows[205], (200, rows[3][1], rows[3][2])]  # repeated rows, one id twice
    rows += [(1000 + i, rows[200][1], (rows[200][2] + i) % 10) for i in range(12)]  # ties
    rows += [(None, rows[100][1], 1), (None, rows[1][1], 2), (300, None, 1), (400, [0.1] * 6, None), (500, [0.1, None], 1)]
    rows += [(600, [float("nan")] * 6, 1), (700, [float("inf")] * 6, 1), (800, [], 1), (900, [0.0] * 6, 2), (1100, [0.5, 0.5], 3)]
    rows += [(2000 + i, [0.3] * 6, 4) for i in range(3)]
    return rows


@pytest.mark.parametrize("part,block,run,focus", [(8192, 8192, 2048, 4), (40, 2, 16, 2), (30, 3, 7, 1)])
def test_matches_plain_python(spark, monkeypatch, part, block, run, focus):
    monkeypatch.setattr(H, "PART_ROWS", part)
    monkeypatch.setattr(H, "ANCHOR_BLOCK", block)
    rows = cases()
    got = H.hard_negatives(H.shifted_labels(vectors(spark, rows)), run_rows=run, focus=focus)
    want = Counter(plain(rows))
    assert bag(got, *COLUMNS) == want and len(want) > 30


def test_matches_sql(spark):
    rows = [r for r in cases(2, 300) if r[1] is None or len(r[1]) == 6]
    con = duckdb.connect()
    con.register("embeddings", pa.table({
        "vec_id": pa.array([r[0] for r in rows], pa.int64()),
        "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
        "label": pa.array([r[2] for r in rows], pa.int32()),
    }))
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({H.NEGATIVES_SQL})").fetchall()
    got = H.hard_negatives(H.shifted_labels(vectors(spark, rows)))
    assert bag(got, *COLUMNS) == Counter(want) and want


def test_pruning_is_exact_and_prunes():
    """Close clusters: few rows are verified, and none of the best is lost."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    v = np.repeat(centres, 100, 0) + rng.normal(size=(3000, 16)) * 0.05
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int64)
    table = pa.table({"vec_id": np.arange(3000), "label": np.zeros(3000, np.int64), "v": v.tolist(), "length": np.sqrt((v * v).sum(1).astype(float))})
    rows = H._Rows(table, 16)
    anchors = rows.take(np.arange(0, 3000, 100))
    kept = [[H.Best(5)] for _ in range(30)]
    verified, pairs = H._search(anchors, kept, rows, True, 256, 4)
    assert verified < 0.4 * pairs
    scores = v[::100] @ v.T
    for i, (best,) in enumerate(kept):
        s = scores[i].copy()
        order = [j for j in np.lexsort((np.arange(3000), -s)) if j != 100 * i][:5]
        assert best.id.tolist() == order and best.score.tolist() == s[order].tolist()


def test_large_components():
    """Products beyond 53 bits are exact, and stop at 64 bits."""
    a = np.array([[(1 << 40) + 1, 3]], np.int64)
    assert H._products(a, a, float("inf"))[0, 0] == min(((1 << 40) + 1) ** 2 + 9, (1 << 63) - 1)
    b = np.array([[(1 << 30) + 1, 3]], np.int64)
    assert H._products(b, b, 2.0**61)[0, 0] == ((1 << 30) + 1) ** 2 + 9


def test_empty_tables(spark):
    assert H.hard_negatives(H.shifted_labels(vectors(spark, [])).limit(0)).count() == 0
    assert H.hard_negatives(H.shifted_labels(vectors(spark, [(1, [0.5], 1), (2, [0.5], 2)]))).count() == 0
    rng = random.Random(1)
    alone = [(100, [rng.random()], 1), (101, [rng.random()], 2)]
    assert H.hard_negatives(H.shifted_labels(vectors(spark, alone))).count() == 0
