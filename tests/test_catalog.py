"""Every named query against its SQL, on the smallest tables."""

import pytest

from catalog import all_queries, all_sql, fixtures
from tools.compare import connect, difference, rows_of

QUERIES, SQL = all_queries(), all_sql()

# Row-at-a-time or batch Python, and pairs of everything with everything.
NEVER = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct")


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in NEVER if word in plan]
    if name not in SQL:
        assert ours[1]
        return
    result = con.execute(SQL[name])
    theirs = rows_of([c[0] for c in result.description], result.fetchall())
    assert difference(ours, theirs) is None


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    rows = {r["size_class"]: r["n_entities"] for r in entry.entry(spark).collect()}
    assert rows == {"toy": 57, "small": 156, "medium": 322, "large": 491, "giant": 454, "unknown": 5}


def test_no_task_makes_more_documents_as_the_orders_grow(spark, sf, monkeypatch):
    monkeypatch.setattr(fixtures, "DOCUMENTS_A_TASK", 100)
    docs = fixtures.documents(spark, sf)
    assert docs.rdd.getNumPartitions() == -(-docs.count() // 100)
