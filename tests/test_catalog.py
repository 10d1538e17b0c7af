"""The registered queries: names, and a sample of them against their SQL."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "selected_records", "node_index", "user_graph", "transitions", "walks_weighted", "skipgram_pairs",
    "side_encode", "similar_topk", "result_table", "huffman_codes",
    "overlapping_sets", "item_set_classes", "member_base_partition",
)


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "part", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["seg_id", "src", "dst", "weight"]


def _norm(rows):
    return Counter(tuple(float(v) if isinstance(v, (int, float)) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = _norm(tuple(r) for r in df.select(*columns).collect())
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert got == _norm(want) and got


def test_recall_of_set_pairs(spark):
    """The min-hash query, as registered, finds at least 0.9 of the true pairs; the inverted lists find them all."""
    sets = entry.queries()["clean_interactions"](spark, SF).selectExpr("member_id AS id", "item_id AS element")
    elements = {}
    for r in sets.collect():
        elements.setdefault(r.id, set()).add(r.element)
    true = set()
    for a in elements:
        for b in elements:
            jaccard = len(elements[a] & elements[b]) / len(elements[a] | elements[b])
            if a != b and 1 - jaccard < 0.95:
                true.add((a, b))
    found = {(r.user1, r.user2) for r in entry.queries()["similar_minhash"](spark, SF).collect()}
    assert found <= true and len(found) >= 0.9 * len(true)
    rep = {r.id: r.rep for r in entry.queries()["item_set_classes"](spark, SF).collect()}
    linked = {(r.lo, r.hi) for r in entry.queries()["overlapping_sets"](spark, SF).collect()}
    linked |= {(hi, lo) for lo, hi in linked}
    assert {(a, b) for a in rep for b in rep if a != b and (rep[a] == rep[b] or (rep[a], rep[b]) in linked)} == true


def test_side_vectors_have_all_components(spark):
    rows = entry.queries()["side_vectors"](spark, SF).collect()
    assert rows and {len(r.vector) for r in rows} == {160}
