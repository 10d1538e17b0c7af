import random

import duckdb
import pytest
from cases import documents, pairs, prose

from walkvec.llm.decontaminate import CONTAMINATION_SQL, clean_documents, decontaminate

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def cases(spark, short):
    rng = random.Random(5)
    items = [prose(rng, n, 5000) for n in (13, 14, 30, 50, 13)]
    items += [items[2], "  ", None, "Mixed-CASE words: here, and ümlaut too; a b c d e f g h i"]
    if short:
        items += ["just four words here", "solo", "just four"]
    texts = [prose(rng, 20) + " " + items[0].upper() + "! " + prose(rng, 5), items[1], items[2] + " " + items[2]]
    words = items[3].split()
    texts += [
        " ".join(words[:20]) + " x " + " ".join(words[20:]),
        " ".join(words[5:17]),  # twelve words: too few
        " ".join(words[5:18]),
        prose(rng, 400) + " " + " ".join(words[7:20]),  # hit, but below a twentieth
        "mixed case WORDS here AND ümlaut TOO a b c d e f g h i",
        "solo " + prose(rng, 30) + " just four words here just four",
        items[0] + items[4],
    ]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts + texts[:2])]
    docs = documents(spark).unionByName(documents(spark, rows))
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(items)], "item_id bigint, text string, key string")
    return docs, benchmark


@pytest.mark.parametrize("short", [False, True])
def test_matches_sql(spark, short):
    docs, items = cases(spark, short)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", items.select("item_id", "text").toPandas())
    want = sorted(map(str, con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({CONTAMINATION_SQL})").fetchall()))
    got = sorted(str(tuple(r)) for r in decontaminate(docs, items).select(*COLUMNS).collect())
    assert got == want


def test_clean_rows_stay(spark):
    docs, items = cases(spark, False)
    bad = {r["doc_id"] for r in decontaminate(docs, items).where("contaminated").collect()}
    assert {0, 1, 2, 3, 5, 7} <= bad and not bad & {4, 6, 9}
    got = clean_documents(docs, items)
    assert got.columns == docs.columns
    assert sorted(map(str, pairs(got))) == sorted(str(p) for p in pairs(docs) if p[0] not in bad or p[1] is None)


def test_empty_tables(spark):
    docs, items = cases(spark, False)
    assert decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).where("contaminated or n_items > 0").count() == 0


def test_no_python(spark):
    docs, items = cases(spark, True)
    plan = decontaminate(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
