"""Every query of the subpackage runs on the smallest tables; found queries against plain searches where one is exact."""

import glob
import os
import re

import duckdb
import pandas as pd
import pytest

from resinv.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["group_num", "field", "record_num"], "p3_found": ["name_a", "name_b"], "p5_found": ["id_a", "id_b"], "p6_found": ["record_num", "field", "pos", "canon_id"],
    "p7_found": ["item_id", "doc_id"], "p9_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(rows) == len(set(rows))
    if name in SQL:
        con = duckdb.connect()
        for p in glob.glob(f"{DATA}/*.parquet"):
            con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
        cur = con.execute(SQL[name])
        order = [[c[0] for c in cur.description].index(c) for c in df.columns]
        assert sorted(rows) == sorted(tuple(r[i] for i in order) for r in cur.fetchall())


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def test_p5_found_is_exact(spark):
    p = pd.read_parquet(f"{DATA}/papers_metadata.parquet")
    p = p[p.id.fillna("").str.strip() != ""]
    sets = {(i, frozenset(words(t) + words(a))) for i, t, a in zip(p.id, p.title, p.abstract)}
    truth = {(i, j) for i, a in sets for j, b in sets if i < j and a | b and 10 * len(a & b) > 7 * len(a | b)}
    assert {tuple(r) for r in QUERIES["p5_found"](spark, DATA).collect()} == truth


def test_p7_found_is_exact(spark):
    docs, items = pd.read_parquet(f"{DATA}/documents.parquet"), pd.read_parquet(f"{DATA}/eval_items.parquet")
    grams = lambda t: {tuple(words(t)[i : i + 12]) for i in range(len(words(t)) - 11)}
    index = {}
    for i, t in zip(items.item_id, items.text):
        for g in grams(t):
            index.setdefault(g, set()).add(i)
    truth = {(i, d) for d, t in zip(docs.doc_id, docs.text) for g in grams(t) for i in index.get(g, ())}
    assert {tuple(r) for r in QUERIES["p7_found"](spark, DATA).collect()} == truth
