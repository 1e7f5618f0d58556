"""Operators that SQL can express, against their check statements."""

import duckdb
import pytest

from conftest import SF
from regiocast.llm.queries import QUERIES
from regiocast.sources.tables import SCHEMAS


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_matches_check_statement(name, spark, duck):
    df = QUERIES[name](spark, SF)
    result = duck.execute(QUERIES[name].sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(tuple(r) for r in df.select(*names).toPandas().astype(object).fillna("-").values)
    want = sorted(tuple(r) for r in result.df().astype(object).fillna("-").values)
    assert got == want
