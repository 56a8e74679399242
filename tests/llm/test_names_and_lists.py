import pytest
from pyspark.sql import functions as F

from resinv.llm.canonical import aligned_cosine, map_to_list, readings
from resinv.llm.names import read_name
from resinv.llm.resources import readable_date, url_alias, url_host
from resinv.llm.rewritings import rewritings
from resinv.llm.survivors import Bundle, Dependency, best_bundles, branch_and_bound
from resinv.llm.variants import as_pairs, classes_of_stem, deletions, name_classes


@pytest.mark.parametrize(
    ("raw", "stem", "subject", "kind", "code"),
    [
        ("Gotafermir Disease Ontology Portal", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("Portal of Gotafermir Disease Ontology", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("Portal Gotafermir for Disease Ontology", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("Disease Ontology Portal, Gotafermir", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("Disease Ontology Portal of Gotafermir", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("Gotafermir: Disease Ontology Portal", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("Gotafermir-Disease-Ontology-Portal", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("The G0tafermir Disease Ontology Portál v2", "gotafermir", ("disease", "ontology"), "portal", ""),
        ("Gotafermir-DO 2.0", "gotafermir", (), "", "do"),
        ("GotafermirDO database", "gotafermir", (), "", "do"),
        ("Gotafermir DO Portal", "gotafermir", (), "portal", "do"),
        ("Gotafermir DOPort", "gotafermir", (), "portal", "do"),
        ('"GotafermirDB"', "gotafermir", (), "", "db"),
        ("Gotafermir Portal", "gotafermir", (), "portal", ""),
        ("<b>Gotafermir</b>", "gotafermir", (), "", ""),
    ],
)
def test_read_name(raw, stem, subject, kind, code):
    n = read_name(raw)
    assert (n.stem, n.subject, n.kind, n.code) == (stem, subject, kind, code)


@pytest.mark.parametrize("raw", [None, "", "  ", "N/A", "n/a", "-"])
def test_no_name(raw):
    assert read_name(raw) is None


def test_classes_of_a_family():
    readings_ = [
        (("disease", "ontology"), "portal", "", 5), (("human", "disease", "ontolgy"), "portal", "", 1), ((), "", "do", 3), ((), "", "dop", 1),
        (("gene", "expression"), "atlas", "", 4), ((), "", "ge", 2), ((), "portal", "", 1), ((), "", "db", 1),
    ]
    c = classes_of_stem(readings_)
    assert c[0] == c[1] == c[2] == c[3] == c[6] and c[4] == c[5] != c[0] and c[7] < 0


def test_deletions_of_swaps_meet():
    assert set(deletions("gotafermir")) & set(deletions("gotafremir")) and deletions("abc") == []


def test_name_classes(spark):
    names = [
        ("1", "Gotafermir Disease Ontology Portal"), ("1", "GotafermirDO"), ("2", "gotafermirdo"), ("3", "Gotafremir Disease Ontology Portal"), ("4", "Gotafermir Gene Expression Atlas"),
        ("4", "Gotafermir-GE"), ("5", "Lurkenbanso Lipid Structure Archive"), ("6", "LurkenbansoDB"), ("7", "LurkenbanDB"), ("7", "Lurkenbanso LS"), ("8", None), ("9", ""), ("10", "N/A"), ("1", "GotafermirDO"),
    ]
    df = spark.createDataFrame(names, "row string, name string").withColumn("class", F.lit("clash")).withColumn("stem", F.lit("clash"))
    got = {r["name"]: r["class"] for r in name_classes(df).collect()}
    assert len(got) == 10
    a, b, c = got["GotafermirDO"], got["Gotafermir-GE"], got["LurkenbansoDB"]
    assert len({a, b, c}) == 3
    assert got["gotafermirdo"] == got["Gotafremir Disease Ontology Portal"] == got["Gotafermir Disease Ontology Portal"] == a
    assert got["Gotafermir Gene Expression Atlas"] == b
    assert got["LurkenbanDB"] == got["Lurkenbanso LS"] == got["Lurkenbanso Lipid Structure Archive"] == c
    pairs = {(r.name_a, r.name_b) for r in as_pairs(name_classes(df)).collect()}
    assert all(x < y for x, y in pairs) and len(pairs) == 6 + 1 + 6
    assert name_classes(df.limit(0)).count() == 0


def test_aligned_cosine_knows_order_typos_and_abbreviations():
    w = {"science": 1.0, "board": 1.2, "fonlian": 2.0}
    assert aligned_cosine("board of science fonlian", "fonlian science board", w, 3.0) == pytest.approx(1.0)
    assert aligned_cosine("fonlain sci board", "fonlian science board", w, 3.0) > 0.8
    assert aligned_cosine("", "fonlian science board", w, 3.0) == 0.0
    assert aligned_cosine("kafuru family trust", "fonlian science board", w, 3.0) < 0.3


def test_readings_of_wrapped_values():
    assert "utopia" in readings("Republic of Utopia") and "utopia" in readings("Utopia UTO") and "utopia" in readings("The Utopia (Republic of)")
    assert "uto" in readings("U.T.O.") and "nsb" in readings("NSB - Nordic")


def test_map_to_list(spark, rows):
    entries = spark.createDataFrame([(1, "Nordic Health Council", "NHC"), (2, "Nordic Health Agency", "NHA"), (3, "Fonlian Science Board", None), (None, "Nobody", "NB"), (4, None, "XX")], "i long, name string, code string")
    values = ["Nordic Helth Council", "council of health, nordic", "nhc", "N.H.A.", "Fonlian Sci. Brd", "Unknown Company", "Nordic Health", "Nordic Helth Council", None, " "]
    df = spark.createDataFrame([(v,) for v in values], "value string").withColumn("eid", F.lit(9)).withColumn("score", F.lit(9))
    got = {r.value: r.canon_id for r in map_to_list(df, "value", entries, "i", "name", ["code"]).collect()}
    assert got == {"Nordic Helth Council": 1, "council of health, nordic": 1, "nhc": 1, "N.H.A.": 2, "Fonlian Sci. Brd": 3, "Unknown Company": 0, "Nordic Health": 0}
    assert map_to_list(df.limit(0), "value", entries, "i", "name", ["code"]).count() == 0
    assert {r.canon_id for r in map_to_list(df, "value", entries.limit(0), "i", "name", ["code"]).collect()} == {0}


@pytest.mark.parametrize(("text", "iso"), [("2020-05-03", "2020-05-03"), ("2020-05", "2020-05-01"), ("2020", "2020-01-01"), ("2020/05/03", "2020-05-03"), ("n.d.", None), ("0000-00-00", None), ("2021-02-30", None), ("", None), (None, None)])
def test_readable_date(spark, text, iso):
    got = spark.createDataFrame([(text,)], "x string").select(readable_date(F.col("x")).cast("string")).head()[0]
    assert got == iso


@pytest.mark.parametrize(("url", "host", "alias"), [("http://www.Gene.org/db/", "gene.org", None), ("https://shared.example/worktool/index.html?x", "shared.example", "worktool"), ("http://", "", None), ("N/A", "", None), (None, "", None), ("http://geneatlas.org", "geneatlas.org", "geneatlas")])
def test_url_host_and_alias(spark, url, host, alias):
    r = spark.createDataFrame([(url,)], "x string").select(F.coalesce(url_host(F.col("x")), F.lit("")), url_alias(F.col("x"))).head()
    assert tuple(r) == (host, alias)


def test_branch_and_bound_maximises_trust_under_dependencies():
    urls = [(0.9, {}, {0: "A"}), (0.8, {}, {0: "B"})]
    places = [(0.9, {0: "B"}, {}), (0.2, {0: "A"}, {})]
    assert branch_and_bound([urls, places]) == [1, 0]
    assert branch_and_bound([[], places]) == [None, 0]
    assert branch_and_bound([]) == []


def test_branch_and_bound_against_brute_force():
    import itertools
    import random

    r = random.Random(3)
    for _ in range(60):
        bundles = [[(r.random(), {b: r.choice("xy")}, {(b + 1) % 3: r.choice("xy")}) for _ in range(r.randint(0, 4))] for b in range(3)]
        got = branch_and_bound(bundles)

        def total(pick):
            chosen = [bundles[b][j] for b, j in enumerate(pick) if j is not None]
            for p, q in itertools.permutations(chosen, 2):
                if any(k in q[1] and q[1][k] != v for k, v in p[2].items()):
                    return -1.0
            return sum(c[0] for c in chosen)

        best = max(total(p) for p in itertools.product(*[[None, *range(len(b))] for b in bundles]))
        assert total(got) == pytest.approx(best)


def test_best_bundles(spark, rows):
    data = [
        (1, 1, "x", 0.5, "h", "A", 1), (1, 2, "y", 0.5, None, None, 2), (1, 3, None, 0.9, "h", "B", 3), (1, 3, None, 0.9, "h", "B", 3), (2, 4, "z", None, None, None, None),
        (None, 5, "q", 1.0, None, None, 1), (3, 6, "a", None, None, None, None), (3, 7, "b", None, None, None, None), (4, 8, None, None, "h", "A", 1), (4, 9, None, None, None, None, None),
    ]
    df = spark.createDataFrame(data, "g long, r long, name string, p double, host string, place string, d int").withColumn("bundle", F.lit("clash")).withColumn("record", F.lit(-1))
    bundles = [Bundle("name", ("name",), F.col("name").isNotNull(), (F.col("p"),)), Bundle("url", ("host",), F.col("host").isNotNull(), (F.col("d"),))]
    assert rows(best_bundles(df, "g", "r", bundles)) == [(1, "name", 1), (1, "url", 3), (3, "name", 6), (4, "url", 8)]
    place = Bundle("place", ("place",), F.col("place").isNotNull(), (F.col("d"),))
    dep = [Dependency("url", F.col("host"), "place", F.col("place"))]
    got = {(g, b): r for g, b, r in rows(best_bundles(df, "g", "r", [*bundles, place], dep))}
    assert got[(1, "name")] == 1 and (1, "url") in got and (1, "place") in got and got[(4, "place")] == 8
    assert best_bundles(df.limit(0), "g", "r", bundles).count() == 0


def test_a_hot_group_has_one_candidate_a_bundle(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 1, id) as g", "id as r", "concat('n', id) as name", "id / 1e6 as p")
    out = best_bundles(df, "g", "r", [Bundle("name", ("name",), F.col("name").isNotNull(), (F.col("p"),))])
    assert [tuple(r) for r in out.filter("g = 1").collect()] == [(1, "name", 29_997)]

REAL = [
    ("GEO", "Gene Expression Omnibus"), ("NCBI GEO data", "Gene Expression Omnibus (GEO)"), ("PDB", "Protein Data Bank"), ("x", "The Protein Data Bank"), ("KEGG", "Kyoto Encyclopedia of Genes and Genomes"),
    ("HPA", "Human Protein Atlas"), ("HMDB", "Human Metabolome Database"), ("SGD", "Saccharomyces Genome Database"), ("MGI", "Mouse Genome Informatics"), ("ENA", "European Nucleotide Archive"),
    ("NCBI", "Natl Center for Biotechnology Information"), ("NCBI", "National Center for Biotechnology Information"), ("GO", "Gene Ontology"), ("TCGA", "The Cancer Genome Atlas"),
]


@pytest.mark.parametrize("apart", [False, True])
def test_acronyms_of_real_names(spark, apart):
    """Long and short names of one resource meet, whether a row holds both or none does."""
    pairs = [p for p in REAL if p[0] not in ("x", "NCBI GEO data") and not (apart and p[0] in ("NCBI", "GO"))]
    lines = [(f"r{i}", n) for i, p in enumerate(REAL) for n in p]
    if apart:
        lines = [(f"l{i}", n) for i, (_, n) in enumerate(lines)]
    got = {r.name: r["class"] for r in name_classes(spark.createDataFrame(lines, "row string, name string")).collect()}
    assert all(got[a] == got[b] for a, b in pairs)
    assert got["Gene Expression Omnibus"] == got["Gene Expression Omnibus (GEO)"] and got["Protein Data Bank"] == got["The Protein Data Bank"]
    longs = {got[b] for _, b in pairs if "(" not in b and not b.startswith("Natl")}
    assert len(longs) == len({b for _, b in pairs if "(" not in b and not b.startswith("Natl")})


def test_an_acronym_of_two_resources_needs_a_row(spark):
    lines = [("1", "Small Genome Database"), ("2", "Sheep Gene Directory"), ("3", "SGD")]
    got = {r.name: r["class"] for r in name_classes(spark.createDataFrame(lines, "row string, name string")).collect()}
    assert len(set(got.values())) == 3
    got = {r.name: r["class"] for r in name_classes(spark.createDataFrame([*lines, ("2", "SGD")], "row string, name string")).collect()}
    assert got["SGD"] == got["Sheep Gene Directory"] != got["Small Genome Database"]


def test_rewritings():
    assert "o:expression gene omnibus" in rewritings("Omnibus of Gene Expression") and "i:geo" in rewritings("Gene Expression Omnibus")
    assert {"i:hmdb", "b:hmdb"} <= set(rewritings("Human Metabolome Database (HMDB)"))
    assert rewritings(None) == rewritings("  ") == [] and rewritings("KEGG") == ["s:kegg"]


def test_long_chains_of_misspelt_stems_are_followed(spark):
    stem = "abcdefghijklmnopqrst"
    names = [stem]
    for i in range(len(stem) - 1):  # each differs from the one before in one letter
        names.append(names[-1][:i] + "z" + names[-1][i + 1 :])
    lines = [(f"{i}-{k}", f"{n.capitalize()} Disease Portal") for i, n in enumerate(names) for k in range(40 - i)]
    got = {r["class"] for r in name_classes(spark.createDataFrame(lines, "row string, name string")).collect()}
    assert len(got) == 1


def test_values_are_decided_by_cosine_then_words_then_codes(spark):
    entries = spark.createDataFrame([(1, "Medical Research Council", "MRC"), (2, "National Institutes of Health", "NIH"), (3, "National Science Foundation", "NSF"), (4, "Wellcome Trust", None)], "i long, name string, code string")
    wanted = {"UK MRC": 1, "nsf grant 1234": 3, "Natl. Sci. Found.": 3, "welcome trust": 4, "Medical Res Council": 1, "none declared": 0, "MRC/NIH": 0}
    got = {r.value: r.canon_id for r in map_to_list(spark.createDataFrame([(v,) for v in wanted], "value string"), "value", entries, "i", "name", ["code"]).collect()}
    assert got == wanted


def test_retrieval_finds_what_scoring_all_pairs_finds(spark):
    """Every entry at or above the retrieval cosine is scored: the prefix bound loses none."""
    import math
    import random

    from resinv.llm.canonical import grams

    r = random.Random(3)
    syllables = ["ka", "fu", "ru", "lon", "ti", "bre", "so", "mi", "tar", "vel"]
    name = lambda: " ".join("".join(r.choice(syllables) for _ in range(3)) for _ in range(3))
    listed = [name() for _ in range(40)]
    typed = sorted({"".join(c for c in x if r.random() > 0.15) for x in listed for _ in range(3)})
    df = {}
    for x in listed:
        for g in grams(x):
            df[g] = df.get(g, 0) + 1
    w = lambda g: math.log1p(40 / df[g]) if g in df else math.log1p(40)
    norm = lambda gs: math.sqrt(sum(w(g) ** 2 for g in gs))
    cosine = lambda a, b: sum(w(g) ** 2 for g in set(grams(a)) & set(grams(b))) / norm(grams(a)) / norm(grams(b))
    truth = {}
    for v in typed:
        best = sorted(((cosine(v, x), -i) for i, x in enumerate(listed)), reverse=True)
        if best[0][0] >= 0.5 and best[1][0] <= best[0][0] - 0.05:
            truth[v] = -best[0][1]
    entries = spark.createDataFrame([(i, x) for i, x in enumerate(listed)], "i long, name string").withColumn("code", F.lit(None).cast("string"))
    got = {r.value: r.canon_id for r in map_to_list(spark.createDataFrame([(v,) for v in typed], "value string"), "value", entries, "i", "name", ["code"]).collect()}
    assert len(truth) > 60 and all(got[v] == i for v, i in truth.items())


def test_no_step_of_the_name_classes_has_a_plan_of_many_shuffles(spark, monkeypatch):
    from resinv.llm import rewritings as whole
    from resinv.llm import variants

    shuffles, cut = [], variants.cut

    def counted(df):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        shuffles.append(plan.count("Join ") + plan.count("Aggregate(") // 2)  # an aggregate is two steps
        return cut(df)

    monkeypatch.setattr(variants, "cut", counted)
    monkeypatch.setattr(whole, "cut", counted)
    occ = spark.createDataFrame([("i1", "Gotafermirdo Protein Database"), ("i1", "GotafermirdoPD"), ("i2", "Gotafermirda Protein Database"), ("i3", "Gotafermir")], "row string, name string")
    classes = {r["name"]: r["class"] for r in name_classes(occ).collect()}
    assert len(classes) == 4 and classes["GotafermirdoPD"] == classes["Gotafermirda Protein Database"] == classes["Gotafermirdo Protein Database"]
    assert max(shuffles) <= 24, str(sorted(shuffles)[-4:])


def test_bundles_without_dependencies_are_not_searched(spark):
    df = spark.createDataFrame([(1, 1, "x", 0.5), (1, 2, "y", 0.5), (1, 3, "z", None), (2, 4, "x", 0.1), (3, 5, None, 1.0), (3, 6, None, 2.0)], "g long, r long, name string, p double")
    bundles = [Bundle("name", ("name",), F.col("name").isNotNull(), (F.col("p"),)), Bundle("p", ("p",), F.col("p").isNotNull(), (F.col("p"),))]
    out = best_bundles(df, "g", "r", bundles)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and plan.count("Aggregate [") == 1
    assert sorted(map(tuple, out.collect())) == [(1, "name", 1), (1, "p", 1), (3, "p", 6)]


def test_no_table_of_names_is_broadcast(spark, monkeypatch, tmp_path):
    # the planner takes an exploded array for one element, so even large tables pass for small ones
    from resinv.llm import queries, resources, variants
    from resinv.llm import rewritings as whole
    from resinv.operators import components as groups

    plans, cut = [], variants.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return cut(df)

    for module in (variants, whole, groups, resources, queries):
        monkeypatch.setattr(module, "cut", seen)
    inventory = [(1, "Gotafermirdo Protein Database", "GotafermirdoPD", None, 0.5, "http://gotafermirdo.example", "2020"), (2, "Gotafermirda Protein Database", None, None, 0.7, None, "2021-02"), (3, "PIDB", "Protein Interaction Database", None, None, None, None)]
    spark.createDataFrame(inventory, "record_num long, best_name string, best_full string, best_common string, best_name_prob double, extracted_url string, publication_date string").write.parquet(f"{tmp_path}/final_inventory.parquet")
    spark.createDataFrame([("7", "Protein Interaction Database", "PIDB"), ("8", "Gotafermirdo Protein Database", None)], "pmid string, primary_entity_long string, primary_entity_short string").write.parquet(f"{tmp_path}/union_papers_with_primary_resources.parquet")
    for name, rows in (("p1_found", 3), ("p3_found", 2)):
        out = queries.QUERIES[name](spark, str(tmp_path))
        plans.append(out._jdf.queryExecution().sparkPlan().toString())
        assert out.count() == rows
    assert len(plans) > 30 and not [p[:300] for p in plans if "Broadcast" in p]
