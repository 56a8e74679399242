import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from resinv.operators.packed import split_cell, split_packed


@pytest.mark.parametrize(
    ("cell", "kind", "values"),
    [
        (None, "id", []),
        ("", "id", []),
        ("  \n ", "person", []),
        ("10000001", "id", ["10000001"]),
        ("10000001|10000002,10000003 10000004;10000005", "id", ["10000001", "10000002", "10000003", "10000004", "10000005"]),
        ("['10000001', '10000002']", "id", ["10000001", "10000002"]),
        ("[10000001, 10000002]", "id", ["10000001", "10000002"]),
        ("10000001,,10000002;", "id", ["10000001", "10000002"]),
        ('"Berg, Anna"', "person", ["Berg, Anna"]),
        ("Berg, A.; C. Dahl;Ek ML", "person", ["Berg, A.", "C. Dahl", "Ek ML"]),
        ("Anna Berg, Carl Dahl, and M. Ek", "person", ["Anna Berg", "Carl Dahl", "M. Ek"]),
        ('Anna Berg & "Dahl, C."', "person", ["Anna Berg", "Dahl, C."]),
        ("Anna van Berg, , Carl Dahl", "person", ["Anna van Berg", "Carl Dahl"]),
        ("Carl Dahl / Anna Berg; \"Ek, M.\"|Bo Falk, Eva Gran", "person", ["Carl Dahl", "Anna Berg", "Ek, M.", "Bo Falk", "Eva Gran"]),
        ("Nordic Science, Technology and Space Board; Health Council", "organisation", ["Nordic Science, Technology and Space Board", "Health Council"]),
        ("Nordic Health Council, NSF, Rare Disease Fund", "organisation", ["Nordic Health Council", "NSF", "Rare Disease Fund"]),
        ("Science Agency, Nordic\nHealth Board", "organisation", ["Science Agency, Nordic", "Health Board"]),
        ("NSB (Nordic Science, Technology and Space Board), Health Board", "organisation", ["NSB (Nordic Science, Technology and Space Board)", "Health Board"]),
        ('"""clinical"" or not? a test; part two" | Genes, cells and maps', "title", ['"clinical" or not? a test; part two', "Genes, cells and maps"]),
        ('["\\"clinical\\" or not?", "Second"]', "title", ['"clinical" or not?', "Second"]),
        ("Utopia; Atlantis, Utopia", "place", ["Utopia", "Atlantis", "Utopia"]),
    ],
)
def test_cells(cell, kind, values):
    assert split_cell(cell, kind) == values


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=32, max_codepoint=0x2FF), min_size=1).map(str.strip).filter(bool), min_size=1, max_size=6))
def test_json_round_trip(values):
    assert split_cell(json.dumps(values, ensure_ascii=False), "title") == values


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abc ,;|\"/"), min_size=1).map(str.strip).filter(lambda v: v and v.strip('"') == v), min_size=2, max_size=5))
def test_quoted_round_trip(values):
    cell = ";".join('"' + v.replace('"', '""') + '"' for v in values)
    assert split_cell(cell, "title") == values


def test_split_packed_null_empty_extra_columns_and_repeats(spark, rows):
    df = spark.createDataFrame([(1, "a1;a2", "x"), (2, None, "y"), (3, "", "z"), (1, "a1;a2", "x"), (None, "b", "w")], "k long, ids string, value string")
    out = split_packed(df, "k", {"ids": "id"})
    assert out.columns == ["k", "field", "pos", "value"]
    assert rows(out) == [(1, "ids", 1, "a1"), (1, "ids", 1, "a1"), (1, "ids", 2, "a2"), (1, "ids", 2, "a2"), (None, "ids", 1, "b")]
    assert split_packed(df.limit(0), "k", {"ids": "id"}).count() == 0


def test_very_long_cell():
    values = [f"1{i:07d}" for i in range(50_000)]
    assert split_cell("; ".join(values), "id") == values
    assert len(split_cell("; ".join(f"P. Berg{i}" for i in range(2000)).replace("0", "o"), "person")) == 2000


def test_marks_that_end_values_are_inferred_per_source(spark):
    """Titles with semicolons inside between bars, told by the stated counts of the other cells of the source."""
    from resinv.operators.packed import infer_sources

    rows = [(i, "Genes; a map|Cells; a view" if i % 4 else "Genes; a map|Cells", 2, "A. Berra;B. Lind") for i in range(40)] + [(99, None, None, None), (98, "", 0, "[]")]
    df = spark.createDataFrame(rows, "k long, titles string, n int, people string").withColumn("field", F.lit("clash"))
    found = infer_sources(df, {"titles": "title", "people": "person"}, {"titles": "n"})
    assert found["titles"] == {(): (), ("|", ";"): ("|",)} and found["people"] == {(): (), (";",): (";",)}
    got = [r.value for r in split_packed(df, "k", {"titles": "title"}, {"titles": "n"}).filter("k = 1").orderBy("pos").collect()]
    assert got == ["Genes; a map", "Cells; a view"]
    assert infer_sources(df.limit(0), {"titles": "title"}) == {"titles": {(): ()}}
