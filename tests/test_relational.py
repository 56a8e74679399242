import random

import pytest
from pyspark.sql import functions as F

from resinv.functions.urls import normal_aggressive, normal_strict, sequence_ratio, url_components, url_similarity
from resinv.operators import relational as R
from resinv.operators.clusters import cross_host_clusters, host_clusters, similar_urls
from resinv.operators.components import components
from resinv.operators.matching import fuzzy_match, sides
from resinv.operators.merge import merge_resources
from resinv.operators.sampling import sample_n, split


def test_keep_first_with_ties_and_nulls(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "x"), (None, 5, "q"), (None, 4, "r")], "k string, o int, v string")
    assert rows(R.keep_first(df, ["k"], ["o", "v"])) == [("a", 1, "x"), (None, 4, "r")]
    assert R.keep_first(df.limit(0), ["k"], ["o"]).count() == 0


def test_keep_ties(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("b", None)], "k string, s double")
    assert rows(R.keep_ties(df, ["k"], "s")) == [("a", 2.0), ("a", 2.0)]


def test_full_provenance(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "k int, p string"), spark.createDataFrame([(1, "y"), (2, "z")], "k int, q string")
    assert rows(R.full_provenance(a, b, "k", ("l", "r"))) == [(1, "x", "y", "both"), (2, None, "z", "r")]


def test_first_hit_takes_list_order(spark, rows):
    df = spark.createDataFrame([(1, ["c", "a", "b"]), (2, ["z"]), (3, [])], "row int, ids array<string>")
    t = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", None)], "id string, u string")
    out = R.first_hit(df, F.col("ids"), t, "id", "u").select("row", "hit", "hit_key")
    assert rows(out) == [(1, "A", "a"), (2, None, None), (3, None, None)]


@pytest.mark.parametrize(("n", "chunks"), [(10, 3), (2, 5), (1, 1), (50, 7), (0, 3)])
def test_chunks_are_balanced(spark, n, chunks):
    df = spark.range(n)
    sizes = [r.n for r in R.chunk_numbers(df, ["id"], chunks).groupBy("chunk").agg(F.count("*").alias("n")).orderBy("chunk").collect()]
    assert sum(sizes) == n and (not sizes or max(sizes) - min(sizes) <= 1) and sizes == sorted(sizes, reverse=True)
    assert len(sizes) == min(n, chunks)


def test_components_chain_cycle_and_singletons(spark, rows):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    assert all(got[i] == 1 for i in range(1, 61)) and got[100] == got[101] == got[102] == 100 and len(got) == 63
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_large_star(spark):
    links = spark.range(1, 5000).selectExpr("0L as a", "id as b")
    out = components(links)
    assert out.count() == 5000 and out.select("component").distinct().count() == 1


def test_host_clusters(spark, rows):
    df = spark.createDataFrame([(3, "http://a.org/2"), (1, "https://A.org/1"), (2, "http://b.org")], "i int, u string")
    assert rows(host_clusters(df, "i", "u").select("i", "canonical", "members")) == [(1, "https://A.org/1", 2), (2, "http://b.org", 1), (3, "https://A.org/1", 2)]


def test_cross_host_clusters(spark):
    df = spark.createDataFrame([("http://genome.org/x",), ("https://www.genome.org/x/",), ("http://genome.org/y",), ("http://other.net",), (None,)], "u string")
    got = {r.url: r.canonical for r in cross_host_clusters(df, "u").collect()}
    assert got["http://genome.org/x"] == got["https://www.genome.org/x/"] == got["http://genome.org/y"] != got["http://other.net"]
    assert len(got) == 4


def test_every_pair_of_a_name_is_compared(spark, rows):
    r = random.Random(3)
    urls = {f"http://{h}.foo.{e}/{r.choice(['x', 'y1', 'data/set', 'data/sets', '1z9', 'q'])}{r.choice(['', '/', '?i=1', '?i=2'])}" for h in ("a", "b", "www", "lab.one", "lab.two") for e in ("org", "net") for _ in range(5)}
    urls |= {"http://a.bar.org/1", "http://a.bar.org/x", "http://b.bar.org/1z9", "http://b.bar.org/x"}
    df = spark.createDataFrame([(u,) for u in sorted(urls)] + [(None,)], "u string")
    pairs = df.select(F.col("u").alias("a")).join(df.select(F.col("u").alias("b")), F.expr("a < b"))
    p, q = url_components("a"), url_components("b")
    ratio = {k: sequence_ratio(F.least(p[k], q[k]), F.greatest(p[k], q[k])) for k in ("domain", "path", "subdomain")}
    equal = (normal_aggressive("a") == normal_aggressive("b")) | (normal_strict("a") == normal_strict("b"))
    brute = pairs.filter(p["domain"] == q["domain"]).select("a", "b", url_similarity(p, q, equal, *ratio.values()).alias("s")).collect()
    for t in (0.5, 0.85, 0.96):
        assert rows(similar_urls(df, "u", t)) == sorted(((x.a, x.b, x.s) for x in brute if x.s >= t), key=str)
        first = {u: u for u in urls}
        for _ in urls:
            for x in brute:
                if x.s >= t:
                    first[x.a] = first[x.b] = min(first[x.a], first[x.b])
        got = {x.url: x.canonical for x in cross_host_clusters(df, "u", t).collect()}
        assert got == first
    assert {got["http://a.bar.org/x"], got["http://b.bar.org/x"]} == {"http://a.bar.org/x"}


MERGE = "pmid string, title string, abstract string, in_linguistic boolean, in_setfit boolean, ling_score double, setfit_confidence double, primary_entity_long string, primary_entity_short string, status string, resource_url string, primary_score double, ner_confidence double, all_long string, all_short string, host string"


def test_merge_counts_a_paper_once_and_keeps_rows_without_url(spark):
    row = lambda p, name, url, all_: (p, f"t{p}", None, True, False, 3.0, None, None, name, "ok", url, 5.0, 0.5, all_, None, "clash")
    df = spark.createDataFrame([row("2", "GeneDB", "http://g.org/a", "b | a"), row("1", "genedb", "http://g.org", "c"), row("1", "genedb", "http://g.org", "c"), row("3", "Solo", None, None)], MERGE)
    got = {r.norm_entity: r for r in merge_resources(df).collect()}
    assert got["genedb"].pmid == "1, 2" and got["genedb"].article_count == 2 and got["genedb"].title == "t1" and got["genedb"].all_long == "a | b | c"
    assert got["solo"].article_count == 1 and got["solo"].host == ""


def test_fuzzy_match_one_to_one(spark):
    s = "n string, l string, u string, o int"
    a = sides(spark.createDataFrame([("GeneDB", None, "http://gene.org", 1), ("GeneDBs", None, "http://gene.org", 2), ("Wormbase2", None, "http://worm.org", 3), (None, None, None, 4), ("", None, None, 5)], s), "n", "l", "u", "o", "a")
    b = sides(spark.createDataFrame([("genedb", None, "http://www.gene.org/", 1), ("wormbase", None, "http://worm.org/", 2)], s), "n", "l", "u", "o", "b")
    got = {r.a_name: r for r in fuzzy_match(a, b).collect()}
    assert got["GeneDB"].score == 10.0 and got["GeneDB"].is_match == "Y"
    assert got["GeneDBs"].is_match == "CONFLICT" and got["GeneDBs"].winner == "GeneDB"
    assert got["Wormbase2"].is_match == "Y" and got["Wormbase2"].b_name == "wormbase"


def test_sampling_and_split_are_seeded(spark):
    df = spark.range(1000)
    assert sample_n(df, 10, 1).collect() == sample_n(df.repartition(7), 10, 1).collect()
    parts = {r.part: r.n for r in split(df, "id", {"a": 0.5, "b": 0.5}).groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert sum(parts.values()) == 1000 and abs(parts["a"] - 500) < 80


def test_prefix_priority_and_column_check(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "y"), (2, "z"), (2, "w")], "k int, v string")
    assert R.prefixed(a, "k", "p_").columns == ["k", "p_v"]
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(R.priority_lookup(keys, [a, b], "k", ["v"])) == [(1, "x"), (2, "w"), (3, None)]
    assert R.column_check(a, ["v", "k", "q"]) == {"missing": ["q"], "unknown": [], "moved": ["k", "v"]}


def test_profiles_from_yaml(tmp_path):
    from resinv.plans.profiles import load_profiles

    p = tmp_path / "c.yaml"
    p.write_text("filtering_profiles:\n  balanced:\n    setfit_threshold: 0.7\n  own:\n    db_keywords: [x]\ndefault_profile: own\n")
    profiles, default = load_profiles(str(p))
    assert default == "own" and profiles["balanced"]["setfit"] == 0.7 and profiles["own"]["keywords"] == ["x"] and profiles["own"]["bypass"] == 5.0
    assert load_profiles(None)[1] == "balanced"


def test_positions_number_a_whole_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert [r.position for r in R.positions(df, ["k"]).orderBy("k").collect()] == list(range(1, 1001))
    assert R.positions(df.limit(0), ["k"]).count() == 0


def test_least_counts_fall_back(spark):
    df = spark.createDataFrame([(1, 5), (3, 1)], "unique_paper_count int, total_paper_count int")
    assert [r[0] for r in R.min_count(df, 2).collect()] == [3]
    assert [r[0] for r in R.min_count(df.drop("unique_paper_count"), 2).collect()] == [5]
    assert R.min_count(df.select(F.lit(1).alias("x")), 2).count() == 2


def test_countries(spark):
    from resinv.operators.countries import extract_countries, standard_country

    c = spark.createDataFrame([(1, "United Kingdom", "GB", "GBR"), (2, "China", "CN", "CHN"), (3, "The Most Serene and Ancient Republic of the Seven Isles", "SI", "SIS")], "country_id long, name string, alpha2 string, alpha3 string")
    t = spark.createDataFrame([(1, "Oxford, UK; the most serene and ancient republic of the seven isles"), (2, "uk and chn"), (3, None), (4, "PRC")], "k int, t string")
    got = lambda form: {r.k: r.countries for r in extract_countries(t, "k", "t", c, form).collect()}
    assert got("full") == {1: "The Most Serene and Ancient Republic of the Seven Isles, United Kingdom", 2: "China", 3: "", 4: "China"}
    assert got("alpha-2")[1] == "GB, SI"
    t = spark.createDataFrame([(1, "gbr"), (2, "kingdom"), (3, " nowhere "), (4, None), (5, "")], "k int, t string")
    assert {r.k: r.country for r in standard_country(t, "k", "t", c, "alpha-2").collect()} == {1: "GB", 2: "GB", 3: "nowhere", 4: "", 5: ""}
    assert standard_country(t, "k", "t", c.limit(0)).count() == 5
