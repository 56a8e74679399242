import difflib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from resinv.functions import names as nx
from resinv.functions import text as fx
from resinv.functions import urls as ux
from resinv.operators.tags import fold, tag_names


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "x string")
    r = df.select(*columns).head()
    return r[0] if len(columns) == 1 else tuple(r)


@pytest.mark.parametrize(("text", "plain"), [("H<sub>2</sub>O", "H2O"), ("<i>E. coli</i>", "E. coli"), ("Aims<h4>Results", "Aims Results"), ("done.</h4>Next", "done. Next"), ("<h2>Title</h2>", "Title"), ("a < b", "a < b")])
def test_strip_xml(spark, text, plain):
    assert one(spark, text, fx.strip_xml("x")) == plain


@pytest.mark.parametrize(("text", "out"), [("", ""), ("A title", "A title."), ("A title.", "A title."), ("Why?", "Why?"), ("Now!", "Now!"), (None, "")])
def test_add_period(spark, text, out):
    assert one(spark, text, fx.add_period("x")) == out


def test_linguistic_score(spark):
    df = spark.createDataFrame([("GeneDB: a database of genes", "Here we present it. Freely available at http://x.org with an API. We used it."), (None, None)], "t string, a string")
    s = fx.linguistic_score("t", "a")
    got = [tuple(r) for r in df.select(*s.values()).collect()]
    assert got[0] == (2 + 1 + 1 + 1.0 - 0.5, "intro_pattern; title_pattern; has_url; impl_kw=2; usage_kw=1", True, True, True, 2, 1)
    assert got[1] == (0.0, "none", False, False, False, 0, 0)


@pytest.mark.parametrize(("title", "entity"), [("The GeneDB: a base", "GeneDB"), ("GeneDB 2.0: news", "GeneDB"), ("A Big Map (ABM): a map", "Big Map"), ("No colon", ""), (None, "")])
def test_title_entity(spark, title, entity):
    assert one(spark, title, fx.title_entity("x")) == entity


@pytest.mark.parametrize(("value", "out"), [("12345678.0", "12345678"), (" 12345678 ", "12345678"), ("abc", None), (None, None), ("", None)])
def test_clean_id(spark, value, out):
    assert one(spark, value, fx.clean_id("x")) == out


@pytest.mark.parametrize(("value", "out"), [("Y", 1), ("true", 1), ("N", 0), ("", 0), (None, 0), ("3", 3), ("maybe", 0)])
def test_flag_to_int(spark, value, out):
    assert one(spark, value, fx.flag_to_int("x")) == out


@pytest.mark.parametrize(("value", "out"), [('["a", null, "b"]', ["a", "b"]), ("[]", []), ("no list", []), (None, []), ("[broken", [])])
def test_json_list(spark, value, out):
    assert one(spark, value, fx.json_list("x")) == out


@pytest.mark.parametrize(
    ("url", "strict"),
    [("http://www.db.com/", "db.com"), ("https://db.com", "db.com"), ("http://db.com/path/", "db.com/path"), ("http://db.com:80/x", "db.com/x"), ("http://db.com/index.html", "db.com"), (None, "")],
)
def test_normal_strict(spark, url, strict):
    assert one(spark, url, ux.normal_strict("x")) == strict


def test_components_of_compound_endings(spark):
    p = ux.url_components("x")
    assert one(spark, "http://www.lab.uni.ac.uk/db/", *[p[k] for k in ("subdomain", "domain", "tld", "path")]) == ("www.lab", "uni", ".ac.uk", "/db")
    m = ux.url_components("x", "match")
    assert one(spark, "http://www.lab.uni.ac.uk/index.html", *[m[k] for k in ("subdomain", "base_domain", "path")]) == ("lab", "uni.ac.uk", "")
    assert one(spark, None, *m.values()) == ("",) * 7


def test_extract_urls_order_and_repeats(spark):
    text = "See http://a.org/x. and www.b.org/y, or HTTP://A.org/x; available at cc.org/z (mail x@d.org)"
    assert one(spark, text, ux.extract_urls("x")) == ["http://a.org/x", "http://www.b.org/y", "cc.org/z"]
    assert one(spark, None, ux.extract_urls("x")) == []


def test_resource_url_prefers_context_and_skips_excluded(spark):
    text = "Code at https://github.com/a/b. The database is available at http://genedb.org/home for all."
    s = ux.resource_url(ux.scored_urls("x"))
    assert one(spark, text, s["resource_url"], s["has_resource_url"], s["all_urls"]) == ("http://genedb.org/home", True, "http://genedb.org/home")
    assert one(spark, "Only https://github.com/a/b here", s["resource_url"], s["has_resource_url"], s["all_urls"]) == ("", False, "https://github.com/a/b")


@pytest.mark.parametrize(("name", "url", "out"), [("genedb", "http://x.org", "genedb"), ("x", "http://coral.org/CoralBase", "CoralBase"), (None, "http://start.org", "start"), ("a|b", "", "a")])
def test_sanitise(spark, name, url, out):
    df = spark.createDataFrame([(name, url, "kept")], "n string, u string, best_name string")
    got = nx.sanitise(df, "n", "u").head()
    assert got.best_name.lower() == out.lower()
    assert got.best_name_original == (name or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=12), st.text(max_size=12)), min_size=1, max_size=20))
def test_sequence_ratio_is_the_textbook_ratio(pairs):
    import pandas as pd

    got = ux.sequence_ratio.func(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    assert list(got) == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_url_similarity_is_symmetric(spark):
    urls = ["http://a.org/x", "http://www.a.org/x", "http://a.org/y", "http://b.org/x", "http://sub.a.org/x", "http://aa.org/x", "http://genome.org", "http://genomes.org"]
    pairs = spark.createDataFrame([(a, b) for a in urls for b in urls], "a string, b string")

    def sim(x, y):
        p, q = ux.url_components(x), ux.url_components(y)
        return ux.url_similarity(p, q, ux.normal_strict(x) == ux.normal_strict(y), *[ux.sequence_ratio(p[k], q[k]) for k in ("domain", "path", "subdomain")])

    for r in pairs.select("a", "b", sim("a", "b").alias("ab"), sim("b", "a").alias("ba")).collect():
        assert abs(r.ab - r.ba) < 0.11 and 0 <= r.ab <= 1
        if r.a == r.b:
            assert r.ab == 1.0


def test_fold_tags():
    assert fold(["The", "Gene", "Bank", "of", "X"], ["O", "B-FUL", "I-FUL", "I-FUL", "O"], [1, 0.8, 0.6, 0.7, 1]) == [("Gene Bank of", "FUL", pytest.approx(0.7))]
    assert fold(["a", "b"], ["I-COM", "B-COM"], [0.5, 0.25]) == [("a", "COM", 0.5), ("b", "COM", 0.25)]
    assert fold([], [], []) == []


def test_tag_names(spark):
    df = spark.createDataFrame([([0, 1, 2], [0, -100, 2])], "i array<int>, t array<int>")
    assert df.select(tag_names(F.col("i"), F.col("t"), ["O", "B-COM", "I-COM"])).head()[0] == ["O", "I-COM"]


def test_acronyms_of_one_paper(spark):
    assert one(spark, "x", nx.is_initials(F.lit("gbx"), F.lit("gene bank xl"))) is True
    assert one(spark, "x", nx.is_initials(F.lit("g"), F.lit("gene bank"))) is False


# one URL per rule, so that every branch is met whatever the inventory holds
PROBES = {
    "https://github.com/a/b": ("excluded_domain:github.com", "GitHub repository", "review", True),
    "http://a.github.io/b": ("", "GitHub Pages", "review", False),
    "https://doi.org/10.1/x": ("excluded_domain:doi.org", "DOI link", "ok", True),
    "https://x.org/paper.pdf": ("", "", "blocked", False),
    "ftp://ftp.x.org/y": ("ftp_protocol", "FTP server", "ok", False),
    "http://www.ncbi.nlm.nih.gov/nuccore": ("reference_db:ncbi.nlm.nih.gov", "", "ok", False),
    "http://lab.school.edu": ("generic_institutional:.edu", "", "ok", False),
    "http://lab.school.edu/db": ("", "", "ok", False),
    "https://zenodo.org/record/1": ("excluded_domain:zenodo.org", "Zenodo archive", "ok", True),
    "http://osf.io/abc": ("excluded_domain:osf.io", "Open Science Framework", "ok", False),
    "": ("", "", "ok", False),
}


def test_url_rules_one_by_one(spark):
    from resinv.functions import urls as ux

    df = spark.createDataFrame([(u,) for u in PROBES], "url string").withColumn("name", F.lit("x"))
    got = {r[0]: tuple(r[1:]) for r in df.select("url", ux.recovery_reason("url", "name"), ux.exclusion_reason("url"), ux.triage("url"), ux.is_excluded_domain("url")).collect()}
    assert got == PROBES


def test_excluded_urls_are_counted_by_reason(spark):
    from resinv.functions import urls as ux

    df = spark.createDataFrame([("https://github.com/a/b|http://x.org|https://github.com/c/d",), ("NOT_FOUND",), (None,), ("ftp://ftp.x.org/y",)], "all_urls string")
    _, reasons = ux.filter_url_list("all_urls")
    got = {r[0]: r[1] for r in df.select(F.explode(reasons).alias("r")).groupBy("r").count().collect()}
    assert got == {"GitHub repository": 2, "FTP server": 1}


def test_literal_lists_and_paper_ids(spark):
    from resinv.functions import text as fx

    df = spark.createDataFrame([("['a', 'b']",), ('["it\'s", "b"]',), ("a, b",), (None,), ("PMID 12345678, 1234567 and 123456 or x12345678",)], "t string")
    got = [tuple(r) for r in df.select(fx.literal_list("t"), fx.paper_ids("t")).collect()]
    assert got == [(["a", "b"], []), (["it's", "b"], []), (None, []), (None, []), (None, ["12345678", "1234567"])]


def test_python_compares_only_texts_that_can_be_alike_enough(spark):
    import random

    rng = random.Random(3)
    texts = ["", "a", "/data", "/data/v2", "Größe der Daten", "protein database"] + ["".join(rng.choice("ab/") for _ in range(rng.randrange(1, 12))) for _ in range(40)]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    for least in (0.7, 0.8, 0.9):
        got = pairs.select(ux.sequence_ratio("a", "b").alias("r"), ux.reached_ratio(F.col("a"), F.col("b"), least).alias("x"), ux.ratio_within_reach(F.col("a"), F.col("b"), least).alias("able")).collect()
        assert all(g.x == g.r for g in got if g.r >= least) and all(g.x < least for g in got if g.r < least)
        assert sum(g.able for g in got) < len(got) / 2
