import hashlib
import random
from collections import Counter

import pytest
from cases import bag, documents, pairs, prose

from walkvec.llm.repeats import SuffixFamily, without_repeats


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = Counter()
    for (doc_id, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out[(doc_id, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_awkward_documents(spark):
    docs = documents(spark)
    assert bag(without_repeats(docs), *COLUMNS) == brute(pairs(docs), 200)


@pytest.mark.parametrize("length,gram,cell,batches", [(20, 6, 4, 3), (24, 24, 8, 1), (30, 10, 16, 5)])
def test_dense_repeats(spark, length, gram, cell, batches):
    rng = random.Random(length)
    parts = [prose(rng, rng.randrange(3, 14), 60) for _ in range(14)]
    rows = [
        "".join(rng.choice(parts) + rng.choice(["", " ", "é", "xy"]) for _ in range(rng.randrange(1, 5))) for _ in range(50)
    ]
    rows += ["a" * 70, "ab" * 40, "b" + "a" * 40, None, "", "é" * 15, "é" * 15 + "x"]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(rows)])
    assert bag(without_repeats(docs, length, gram, cell, batches), *COLUMNS) == brute(pairs(docs), length)


def test_levels_merge_geometrically(spark):
    family = SuffixFamily(spark)
    sizes = []
    for b in range(6):
        rows = [(b * 10 + i, (b * 3 + i) % 7) for i in range(4)]
        family.add(spark.createDataFrame(rows, "row bigint, g bigint"))
        sizes.append(sorted(family.levels))
    assert sizes == [[1], [2], [1, 2], [4], [1, 4], [2, 4]]
    assert sum(spark.table(t).count() for t in family.levels.values()) == 24
    family.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(family.name)]


def test_empty_table(spark):
    assert without_repeats(documents(spark).limit(0)).count() == 0
