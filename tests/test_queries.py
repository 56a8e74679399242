"""Every registered query runs on the smallest tables, and those with SQL equal it."""

import glob
import math
import os

import duckdb
import pytest

from resinv.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        if isinstance(v, bool):
            return str(v)
        return f"{float(v):.9g}" if isinstance(v, (int, float)) else str(v)

    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    if name not in catalogue.sql():
        assert df.columns
        return
    cur = duck.execute(catalogue.sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(got, df.columns) == canonical(cur.fetchall(), columns)


def test_entry_without_the_training_data_subpackage(monkeypatch):
    import __spark_entry__ as e

    monkeypatch.setattr(e, "_extra", lambda: None)
    assert set(e.queries()) == set(catalogue.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert catalogue.FLAGSHIP in e.queries()
