import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from resinv.plans import pipeline as P
from resinv.plans.stages import STAGES
from resinv.sources import providers, readers, scanner, sinks
from resinv.streaming.incremental import run_stage, score_stage

DATA = "/root/testdata/sf0.001"


def test_csv_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", line\nbreak'), (2, "é"), (3, None)], "i int, t string")
    for quote_all in (False, True):
        p = sinks.write_csv(df, str(tmp_path / f"{quote_all}.csv"), quote_all)
        assert rows(readers.read_csv(spark, p, "i int, t string")) == rows(df)


def test_id_list_is_sorted_by_number(spark, tmp_path):
    df = spark.createDataFrame([("10",), ("9",), ("9",), (None,), (" ",)], "i string")
    p = sinks.write_ids(df, "i", str(tmp_path / "ids.txt"))
    assert Path(p).read_text().split() == ["9", "10"]
    assert {r.id for r in readers.read_id_list(spark, p).collect()} == {"9", "10"}


def test_statistics_report_chunks_and_replace(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "n")
    stats = sinks.write_statistics(df.agg(F.count("*").alias("rows")), str(tmp_path / "s.json"))
    assert stats == json.loads((tmp_path / "s.json").read_text()) == {"rows": 10}
    assert "| n |" in Path(sinks.write_report("R", {"Rows": df}, str(tmp_path / "r.md"))).read_text()
    assert spark.read.option("header", True).csv(sinks.write_chunks(df, ["n"], 3, str(tmp_path / "c"))).groupBy("chunk").count().count() == 3
    target = str(tmp_path / "t.parquet")
    assert sinks.replace_table(df, target) is None
    backup = sinks.replace_table(df.limit(2), target)
    assert spark.read.parquet(target).count() == 2 and spark.read.parquet(backup).count() == 10


def test_newest_and_first_existing(tmp_path):
    for n in ("a_1.csv", "a_2.csv"):
        (tmp_path / n).write_text("x")
        time.sleep(0.02)
    assert readers.newest([str(tmp_path / "none*"), str(tmp_path / "a_*.csv")]).endswith("a_2.csv")
    assert readers.newest(str(tmp_path / "none*")) is None
    with pytest.raises(FileNotFoundError):
        readers.first_existing([str(tmp_path / "none")])


def test_results_are_validated(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("original_record_num,database_name,found_urls,url_source,match_quality\n1,X,http://x.org,abstract,HIGH\nz,,u,nowhere,GOOD\n")
    table, bad = readers.read_results(spark, [str(tmp_path / "a.csv")])
    assert table.count() == 2 and bad.count() == 4
    with pytest.raises(ValueError, match="record"):
        readers.read_results(spark, [str(tmp_path / "a.csv")], strict=True)


def test_json_cache_and_flat_papers(spark, rows, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"1": {"a": "x"}, "2": {"a": None}}))
    assert rows(readers.read_json_cache(spark, str(tmp_path / "c.json"), "struct<a:string>").select("id", "value.a")) == [("1", "x"), ("2", None)]
    doc = {"id": "7", "title": "T", "pubYear": "2020", "keywordList": {"keyword": ["k"]}, "authorList": {"author": [{"authorAffiliationDetailsList": {"authorAffiliation": [{"affiliation": "U"}, {"affiliation": "U"}]}}, {}]}}
    df = spark.createDataFrame([(json.dumps(doc),), ("broken",)], "j string")
    got = readers.flat_papers(df, "j").filter("id = '7'").head()
    assert (got.pubYear, got.keywords, got.meshTerms, got.authorAffiliations) == (2020, '["k"]', "[]", "U")


class Echo:
    schema = "id string, title string"

    def fetch(self, ids):
        return [(i, f"title {i}") for i in ids if i != "9"]


def test_look_up_uses_the_cache(spark, rows):
    ids = spark.createDataFrame([("1",), ("2",), ("9",), ("2",), (None,)], "pmid string")
    cache = spark.createDataFrame([("1", "cached"), ("5", "other")], "id string, title string")
    assert rows(readers.look_up(ids, "pmid", Echo(), cache)) == [("1", "cached"), ("2", "title 2")]


def test_paged_search():
    pages = {"q 2020 2021": {"results": [1], "next": "n"}, "n": {"results": [2]}}
    assert list(readers.paged(pages.__getitem__, "q {} {}", "2020", "2021")) == [[1], [2]]
    with pytest.raises(ValueError):
        list(readers.paged(pages.__getitem__, "q {} {}", "x", "2021"))


def test_scan_follows_refreshes_keeps_errors_and_asks_the_archive(spark):
    pages = {"http://a.org/x/": '<meta http-equiv="refresh" content="0; url=../y">', "http://a.org/y": "<title>Gene database</title>", "http://loop.org/": '<meta http-equiv=refresh content="0;url=/">'}

    def fetch(u):
        if "slow" in u:
            time.sleep(3)
        if u not in pages:
            raise OSError("down")
        return 200, u, pages[u]

    urls = spark.createDataFrame([("http://a.org/x/",), ("http://bad.org",), (None,), (" ",), ("http://a.org/x/",), ("http://loop.org/",), ("http://slow.org",)], "u string")
    archive = spark.createDataFrame([("http://bad.org", "20200101000000", "old"), ("http://bad.org", "20210203040506", "a"), ("http://bad.org", "20210203040506", "b"), ("http://a.org/x/", "20200101000000", "c")], "url string, stamp string, archive_url string")
    got = {r.url: r for r in scanner.scan_urls(urls, "u", fetch, archive, seconds=1.0).collect()}
    a, bad = got["http://a.org/x/"], got["http://bad.org"]
    assert (a.final_url, a.hops, a.title, a.status, a.wayback_url) == ("http://a.org/y", 1, "Gene database", "ok", "") and a.total_score > 5
    assert (bad.status, bad.wayback_url, bad.wayback_date) == ("error", "b", "2021-02-03") and "down" in bad.error_message
    assert got["http://loop.org/"].hops == 0 and "timeout" in got["http://slow.org"].error_message and len(got) == 4
    assert scanner.scan_urls(urls.limit(0), "u", fetch).count() == 0


def test_liveness_and_places(spark):
    places = spark.createDataFrame([("1.1", "DE", "1,2"), ("1.1", "FR", "3,4")], "address string, country string, coordinates string")
    got = {r.url: tuple(r)[1:] for r in scanner.check_urls(spark.createDataFrame([("http://a.org",), ("http://b.org",)], "u string"), "u", lambda u: (200, "1.1") if "a" in u else (500, "9.9"), places).collect()}
    assert got == {"http://a.org": (200, "1.1", True, "DE", "1,2", None), "http://b.org": (500, "9.9", False, "", "", None)}


@pytest.mark.parametrize("target", ["", "/a", "b.html", "//h.org/c", "?q=2", "#top", "http://z.org/", "mailto:x"])
@pytest.mark.parametrize("base", ["http://x.org", "http://x.org/d/e?f#g", "https://x.org/d/"])
def test_resolved_against_the_standard(spark, base, target):
    from urllib.parse import urljoin

    from resinv.functions.urls import resolved

    assert spark.range(1).select(resolved(F.lit(target), F.lit(base))).head()[0] == (urljoin(base, target) if target else "")


def test_entity_rows_have_offsets_and_do_not_overlap(spark):
    docs = spark.createDataFrame([(1, "The Gene-Bank of (gene  bank) GENE"), (2, None), (3, "")], "i int, t string")
    patterns = spark.createDataFrame([("Gene Bank", "COM", "gb"), ("gene", "COM", "g"), ("GENE", "ALT", "z"), (None, "x", "y")], "pattern string, label string, canonical_id string")
    got = sorted(tuple(r) for r in providers.entity_rows(docs, "i", "t", patterns).collect())
    assert got == [(1, "GENE", "ALT", "z", "pattern", 30, 34), (1, "Gene-Bank", "COM", "gb", "pattern", 4, 13), (1, "gene  bank", "COM", "gb", "pattern", 18, 28)]
    assert providers.entity_rows(docs, "i", "t", patterns.limit(0)).count() == 0


def test_token_and_function_models(spark):
    df = spark.createDataFrame([(1, "the Gene Bank here"), (2, None)], "i int, t string")
    load = lambda: lambda texts: [[("B-COM" if w == "Gene" else "I-COM" if w == "Bank" else "O", 0.5) for w in ws] for ws in texts]
    assert [tuple(r) for r in providers.TokenTagger(load, "t").rows(df, "i").collect()] == [(1, "Gene Bank", "COM", 0.5)]
    scored = providers.FunctionScorer(lambda: lambda texts: [(len(x),) for x in texts], "t", "n long").score(df)
    assert sorted(r.n for r in scored.collect()) == [0, 18]
    assert {r.i: r.s for r in providers.TableScorer(spark.createDataFrame([(1, 9)], "i int, s int"), "i").score(df).collect()} == {1: 9, 2: None}


def test_tabular_classifier_and_its_files(spark, tmp_path):
    df = spark.createDataFrame([(float(i), None if i % 7 == 0 else 1.0, int(i > 50)) for i in range(100)], "a double, b double, label int")
    model = providers.TabularClassifier(["a", "b"]).fit(df, "label")
    assert model.score(df).filter("prediction = label").count() >= 90
    sinks.write_model(model.model, str(tmp_path / "m"), spark, {"f1": 0.9})
    assert json.loads((tmp_path / "m" / "metrics.json").read_text()) == {"f1": 0.9} and (tmp_path / "m" / "model").exists()


def test_look_up_in_steps_keeps_what_it_fetched(spark, rows, tmp_path):
    ids = spark.createDataFrame([(str(i),) for i in range(12)], "pmid string")
    cache = str(tmp_path / "cache")
    spark.createDataFrame([("1", "cached")], "id string, title string").write.parquet(cache)
    got = dict(rows(readers.look_up_in_steps(ids, "pmid", Echo(), cache, steps=3)))
    assert got["1"] == "cached" and got["2"] == "title 2" and len(got) == 11 and spark.read.parquet(cache).count() == 11


def test_search_by_months(spark, rows):
    provider = lambda url: {"results": [{"id": url}], "next": None}
    got = readers.search(spark, provider, "{}..{}", "2020-11-15", "2021-01")
    assert sorted(json.loads(r.record)["id"] for r in got.collect()) == ["2020-11-15..2020-11-30", "2020-12-01..2020-12-31", "2021-01-01..2021-01-01"]
    with pytest.raises(RuntimeError):
        list(readers.paged(lambda u: {"results": [], "next": u}, "{} {}", "2020", "2021", limit=3))


def test_chunks_come_with_a_brief(spark, tmp_path):
    sinks.write_chunks(spark.range(5).toDF("k"), ["k"], 2, str(tmp_path / "c"), "Search these.")
    assert (tmp_path / "c" / "BRIEF.md").read_text() == "Search these.\n\n- chunk 1: 3 rows\n- chunk 2: 2 rows\n"


def test_review_outputs(spark, tmp_path):
    df = spark.createDataFrame([("a", "X", "ok", "http://a"), ("b", "", "review", "http://b"), ("c", None, "ok", " ")], "best_name string, name_modification_flags string, url_validation string, extracted_url string")
    assert [spark.read.option("header", True).csv(p).count() for p in sinks.review_outputs(df, str(tmp_path))] == [1, 1, 1]


def test_classifier_learns(spark):
    rows = [(f"we present a new database of genes {i}", 1) for i in range(40)] + [(f"we used the method and found cells {i}", 0) for i in range(40)]
    df = spark.createDataFrame(rows, "text string, label int")
    model = providers.TextClassifier("text").fit(df, "label")
    assert model.score(df).filter("prediction = label").count() >= 76


def test_dictionary_entities(spark, rows):
    docs = spark.createDataFrame([(1, "The Gene-Bank, gene bank and GENE"), (2, None)], "i int, t string")
    names = spark.createDataFrame([("Gene Bank",), ("gene",), (None,)], "n string")
    assert rows(providers.dictionary_entities(docs, "i", "t", names, "n")) == [(1, "gene bank", 2), (1, "gene", 3)]


def test_phases_and_profiles():
    assert P.phases_to_run() == [2, 3, 4, 5, 7, 6, 8, 9]
    assert P.phases_to_run(start=5, end=6) == [5, 7, 6]
    assert P.phases_to_run(only=4) == [4]
    assert P.parse_profiles("all") == ["conservative", "balanced", "aggressive"]
    with pytest.raises(ValueError):
        P.parse_profiles("x")
    assert P.duration(3725) == "1h 2m 5s"


def test_pipeline_runs_and_resumes(spark, tmp_path):
    inputs = {
        "ner_union": spark.read.parquet(f"{DATA}/ner_union.parquet"),
        "papers": spark.read.parquet(f"{DATA}/papers_metadata.parquet"),
        "documents": spark.read.parquet(f"{DATA}/documents.parquet"),
        "countries": spark.read.parquet(f"{DATA}/country_list.parquet"),
        "known": spark.read.parquet(f"{DATA}/union_papers_with_primary_resources.parquet"),
        "scans": spark.read.parquet(f"{DATA}/papers_with_scanner_scores.parquet"),
    }
    session = P.Session.new(spark, str(tmp_path), inputs)
    assert all(e["status"] == "planned" for e in P.run_pipeline(session, STAGES, dry_run=True))
    session.log.clear()
    log = P.run_pipeline(session, STAGES, profiles=["aggressive"])
    assert {e["status"] for e in log} == {"done"}
    final, merged = session.table("inventory_aggressive"), session.table("merged_aggressive")
    assert final.count() == merged.count() == session.table("dedup_aggressive").count() > 0
    own = session.table("dedup_aggressive").filter("trim(coalesce(resource_url, '')) <> ''").count()
    assert merged.filter("url_origin = 'original'").count() == own and final.filter("url_origin <> 'none' and trim(coalesce(extracted_url, '')) = ''").count() == 0
    assert {e["state"] for e in P.status(session, STAGES, ["aggressive"])} == {"done"} and len(session.description()["steps"]) == len(log)
    assert [s.root for s in P.Session.all(spark, str(tmp_path))] == [P.Session.latest(spark, str(tmp_path)).root]
    again = P.Session.latest(spark, str(tmp_path))
    assert {e["status"] for e in P.run_pipeline(again, STAGES, profiles=["aggressive"])} == {"skipped"}
    stopped = P.Session(spark, session.root)
    assert P.run_pipeline(stopped, STAGES, phases=[8], pause=lambda _: False)[-1]["status"] == "stopped"


def test_pipeline_stops_or_goes_on_at_errors(spark, tmp_path):
    session = P.Session.new(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        P.run_pipeline(session, STAGES, phases=[2])
    assert P.run_pipeline(P.Session(spark, session.root), STAGES, phases=[2, 3], continue_on_error=True)[-1]["status"] == "failed"


def test_streamed_stage_appends_only_new_rows(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], "id string, title string, abstract string").schema
    spark.createDataFrame([("1", "GeneDB: a database", "x")], schema).write.parquet(source)
    run_stage(spark, source, schema, score_stage, target, state, "id")
    spark.createDataFrame([("1", "GeneDB: a database", "x"), ("2", "b", None)], schema).write.mode("append").parquet(source)
    run_stage(spark, source, schema, score_stage, target, state, "id")
    run_stage(spark, source, schema, score_stage, target, state, "id")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["1", "2"]


def test_recovered_urls_reach_the_inventory(spark):
    from resinv.plans.stages import merge, recover

    mapped = spark.createDataFrame([("1", "see https://a.example.org/db for it", ""), ("2", "none", None), ("3", "none", "http://own.org")], "pmid string, abstract string, resource_url string")
    documents = spark.createDataFrame([("2", "we host it at http://b.example.org/x."), (None, "http://c.example.org")], "pmid string, text string")
    found = recover(mapped, documents)
    assert {r.pmid: (r.found_urls, r.url_source) for r in found.collect()} == {"1": ("https://a.example.org/db", "abstract"), "2": ("http://b.example.org/x", "fulltext")}
    dedup = spark.createDataFrame([("", "a", "1", None), ("", "b", "2", ""), ("own.org", "c", "3", "http://own.org"), ("", "d", "9", None)], "host string, norm_entity string, pmid string, resource_url string")
    scanned = spark.createDataFrame([("1", 7, "MEDIUM")], "pmid string, url_scanner_score int, url_likelihood string")
    got = {r.norm_entity: (r.resource_url, r.url_origin, r.url_scanner_score) for r in merge(dedup, found, scanned).collect()}
    assert got == {"a": ("https://a.example.org/db", "recovered", 7), "b": ("http://b.example.org/x", "recovered", None), "c": ("http://own.org", "original", None), "d": (None, "none", None)}


def test_profiles_of_a_configuration_take_effect(spark, tmp_path):
    from resinv.plans.profiles import load_profiles
    from resinv.plans.stages import stages

    (tmp_path / "p.yaml").write_text("filtering_profiles:\n  mine: {db_keywords: [zzz], linguistic_bypass_threshold: 99, setfit_threshold: 0.1, require_url: false}\ndefault_profile: mine\n")
    known, default = load_profiles(str(tmp_path / "p.yaml"))
    step = next(s for s in stages(known) if s.name == "dedup")
    columns = "pmid string, title string, abstract string, in_linguistic boolean, in_setfit boolean, ling_score double, setfit_confidence double, primary_entity_long string, primary_entity_short string, status string, resource_url string, has_resource_url boolean, primary_score double, ner_confidence double, all_long string, all_short string"
    mapped = spark.createDataFrame([("1", "A zzz of genes", None, True, True, 1.0, 0.9, "Z", None, None, None, False, 1.0, 1.0, None, None), ("2", "A database", None, True, True, 1.0, 0.9, "D", None, None, None, True, 1.0, 1.0, None, None)], columns)
    assert default == "mine" and [r.norm_entity for r in step.run(mapped, "mine").collect()] == ["z"]
    assert P.parse_profiles("all", known) == list(known)
