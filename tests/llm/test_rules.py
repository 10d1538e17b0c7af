import duckdb
from cases import bag, documents
from pyspark.sql import functions as F

from walkvec.llm import quality_rules as q


def by_sql(docs, sql):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    return con.execute(sql)


def test_ledger_matches_sql(spark):
    docs = documents(spark)
    result = q.judged_documents(docs)
    cursor = by_sql(docs, q.RULES_SQL)
    names = [d[0] for d in cursor.description]
    want = sorted((tuple(r) for r in cursor.fetchall()), key=str)
    got = sorted((tuple(r) for r in result.select(*names).collect()), key=str)
    assert got == want


def test_policies_and_ablation(spark):
    rows = q.ledger(q.measurements(documents(spark).select("doc_id", "text")))
    ledger = [(r["failed"],) for r in rows.collect()]
    places = {r.name: 1 << i for i, r in enumerate(q.RULES)}
    for policy in (q.BASE, q.STANDARD):
        mask = sum(places[n] for n in policy.rules)
        assert q.mask(policy) == mask
        kept = rows.where(q.passes(policy)).count()
        assert kept == sum(1 for (f,) in ledger if not f & mask)
        table = {r["rule"]: (r["n_failed"], r["n_only"]) for r in q.ablation(rows, policy).collect()}
        for name in policy.rules:
            want = (
                sum(1 for (f,) in ledger if f & places[name]),
                sum(1 for (f,) in ledger if f & mask == places[name]),
            )
            assert table[name] == want


def test_one_pass_over_the_texts(spark):
    plan = q.judged_documents(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_empty_table_and_extra_columns(spark):
    docs = documents(spark)
    assert q.judged_documents(docs.limit(0)).count() == 0
    assert sum(bag(q.judged_documents(docs), "doc_id").values()) == docs.count()
    assert docs.select(F.count("*")).first()[0] == docs.count()
