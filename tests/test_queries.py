"""Every named query with SQL gives the same rows as that SQL in DuckDB."""

import duckdb
import pytest

from conftest import SF
from millrace.plans.catalog import all_queries
from millrace.session import TABLES
from tools.check import TYPES, canonical

QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(k for k, q in QUERIES.items() if q.oracle))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(QUERIES[key].oracle)
    names, types = [d[0] for d in cur.description], [TYPES.get(str(d[1])) for d in cur.description]
    expect = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == dict(zip(names, types))
    assert canonical(got, df.columns) == canonical(expect, names)


@pytest.mark.parametrize("key", sorted(k for k, q in QUERIES.items() if not q.oracle))
def test_query_without_sql_gives_rows(spark, key):
    assert len(QUERIES[key](spark, SF).take(1)) == 1
