import os

import duckdb
import pytest

import __spark_entry__ as entry
from strandlake.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"create view {name.split('.')[0]} as select * from '{DATA}/{name}'")
    return con


def rows(table):
    table = table[sorted(table.columns)]
    return sorted(tuple("" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in table.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, DATA).toPandas()
    want = duck.sql(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.astype(want.dtypes.to_dict(), errors="ignore")) == rows(want)


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
