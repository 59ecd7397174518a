"""Every query with SQL against DuckDB on the smallest tables; every other one must run."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tessel.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if type(v).__name__ == "Decimal":
        return repr(round(float(v), 9))
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    if name in catalog.ORACLES:
        r = duck.execute(catalog.ORACLES[name])
        names = [d[0] for d in r.description]
        assert sorted(names) == columns
        assert rows == sorted(tuple(norm(x[names.index(c)]) for c in columns) for x in r.fetchall())


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_outside_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, files in os.walk(os.path.join(root, "tessel")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert not re.search(r"tessel\.llm|from \.+llm", open(os.path.join(folder, f), encoding="utf-8").read()), f
