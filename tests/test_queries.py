"""Every registered query against its check statement, on whole tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from conftest import SF
from regiocast.catalog import load_all
from regiocast.sources.tables import SCHEMAS

CATALOG = load_all()
INVENTORY = (
    [f"A{i}" for i in range(1, 15)] + [f"B{i}" for i in range(1, 14)]
    + [f"C{i}" for i in range(1, 12)] + [f"G{i}" for i in range(1, 17)]
    + [f"E{i}" for i in range(1, 12)] + [f"L{i}" for i in range(1, 5)] + ["U1", "U2"]
    + [f"S{i}" for i in range(1, 18)] + [f"T{i}" for i in range(1, 8)]
    + [f"X{i}" for i in range(1, 15)] + [f"F{i}" for i in range(1, 16)]
    + [f"D{i}" for i in range(1, 10)] + ["M1"] + [f"V{i}" for i in range(1, 11)]
    + [f"N{i}" for i in range(1, 7)] + [f"Q{i}" for i in range(1, 10)])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool):
        return repr(int(v))
    if isinstance(v, (int, float)):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v) + 0.0)
    if isinstance(v, datetime.datetime) and v.time() == datetime.time(0):
        v = v.date()
    return repr(v)


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if q.sql))
def test_matches_check_statement(name, spark, duck):
    df = CATALOG[name](spark, SF)
    got_names, rows = df.columns, df.collect()
    result = duck.execute(CATALOG[name].sql)
    want_names = [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(got_names) == sorted(want_names)
    order = sorted(got_names)
    a = sorted(tuple(plain(r[c]) for c in order) for r in rows)
    b = sorted(tuple(plain(r[want_names.index(c)]) for c in order) for r in want)
    assert a == b


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if not q.sql))
def test_runs_with_rows(name, spark):
    assert not CATALOG[name](spark, SF).isEmpty()


def test_inventory_is_covered():
    covered = {c for q in CATALOG.values() for c in q.covers}
    assert [row for row in INVENTORY if row not in covered] == []


def test_entry_contract(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["series", "ts", "forecast", "lower_bound", "upper_bound", "share",
                          "share_pct"]
    assert abs(sum(r["share"] for r in df.collect()) - 1) < 1e-9
