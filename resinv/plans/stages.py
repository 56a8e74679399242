"""The standard stages: tables in, one table out; no action inside a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resinv.functions import fixed as X
from resinv.functions import names as nx
from resinv.functions import text as fx
from resinv.functions import urls as ux
from resinv.operators import relational as R
from resinv.operators.countries import extract_countries
from resinv.operators.merge import merge_resources
from resinv.plans.inventory_queries import layout, paper_facts
from resinv.plans.pipeline import Stage


def union_entities(ner: DataFrame) -> DataFrame:
    rows = ner.select(fx.clean_id("publication_id").alias("pmid"), "entity_text", "entity_type", "confidence", "source").filter("pmid is not null and trim(coalesce(entity_text, '')) <> ''")
    return R.keep_first(rows, ["pmid", "entity_text", "entity_type"], [F.when(F.col("source") == "spacy", 0).otherwise(1), F.desc_nulls_last("confidence")])


def score(papers: DataFrame, entities: DataFrame) -> DataFrame:
    one = R.keep_first(papers.filter("trim(coalesce(id, '')) <> ''"), ["id"], ["title", "abstract"])
    named = one.join(entities.select(F.col("pmid").alias("id")).distinct(), "id", "left_semi")
    scored = named.select(F.col("id").alias("pmid"), "title", "abstract", *[v.alias(k) for k, v in fx.linguistic_score("title", "abstract").items()])
    return scored.withColumn("tier", fx.score_tier(F.col("ling_score")))


def classify(scored: DataFrame, known: DataFrame) -> DataFrame:
    """The few-shot scores of the medium tier, from the table of a model run elsewhere."""
    return scored.filter("tier = 'medium'").select("pmid").join(known.select("pmid", "setfit_confidence").dropDuplicates(["pmid"]), "pmid", "left")


def paper_sets(scored: DataFrame, classified: DataFrame) -> DataFrame:
    a = scored.filter("ling_score >= 3.0").select("pmid", "ling_score")
    b = classified.filter("setfit_confidence >= 0.60")
    return R.full_provenance(a, b, "pmid", ("linguistic_only", "setfit_only"))


def primary(sets: DataFrame, scored: DataFrame, known: DataFrame) -> DataFrame:
    names = known.select("pmid", "primary_entity_long", "primary_entity_short", "primary_score", "status", "ner_confidence", "all_long", "all_short").dropDuplicates(["pmid"])
    j = sets.join(scored.select("pmid", "title", "abstract"), "pmid").join(names, "pmid", "left")
    j = j.withColumn("in_linguistic", F.col("source").isin("both", "linguistic_only")).withColumn("in_setfit", F.col("source").isin("both", "setfit_only"))
    s = ux.resource_url(ux.scored_urls("abstract"))
    return j.select("*", *[v.alias(k) for k, v in s.items()], fx.has_db_keyword("title").alias("db_keyword_found"), fx.db_keyword_score("title").alias("db_keyword_score"))


def dedup(mapped: DataFrame, profile: str | dict) -> DataFrame:
    keep = fx.passes_profile(profile, F.col("title"), F.col("ling_score"), F.col("setfit_confidence"), F.col("has_resource_url"))
    return merge_resources(mapped.filter(keep))


def scan(mapped: DataFrame, scans: DataFrame) -> DataFrame:
    one = R.keep_first(scans, ["pmid"], [F.desc_nulls_last("scanned_at"), F.desc_nulls_last("url_scanner_score")])
    return R.lookup_default(mapped, one, "pmid", {"url_scanner_score": 0, "url_likelihood": "NOT_SCANNED", "url_scan_status": "not_scanned"})


def recover(mapped: DataFrame, documents: DataFrame) -> DataFrame:
    """For papers without a URL those of the abstract, else those of the full texts, with where they were found."""
    usable = lambda text: F.filter(ux.extract_urls_recovery(text), lambda u: ux.exclusion_reason(u) == "")
    need = mapped.filter(F.trim(fx.filled("resource_url")) == "").select("pmid", usable("abstract").alias("a"))
    texts = documents.filter("pmid is not null").select("pmid", F.explode(usable("text")).alias("u")).groupBy("pmid").agg(F.array_sort(F.collect_set("u")).alias("f"))
    found = need.join(texts, "pmid", "left")
    source = F.when(F.size("a") > 0, "abstract").when(F.size("f") > 0, "fulltext").otherwise("not_available")
    return found.select("pmid", F.array_join(F.when(F.size("a") > 0, F.col("a")).otherwise(F.coalesce("f", F.array().cast("array<string>"))), "|").alias("found_urls"), source.alias("url_source"))


def merge(merged: DataFrame, recovered: DataFrame, scanned: DataFrame) -> DataFrame:
    """The resources with the URL to publish - their own, else the first one recovered for a paper of theirs, else
    none - where it comes from, and the best scan of their papers."""
    papers = merged.select("host", "norm_entity", F.explode(F.split("pmid", ", ")).alias("pmid"))
    hits = recovered.filter("found_urls <> ''").select("pmid", F.split("found_urls", "[|]")[0].alias("u"))
    per = papers.join(hits, "pmid").groupBy("host", "norm_entity").agg(F.min(F.struct("pmid", "u"))["u"].alias("_r"))
    best = papers.join(scanned.select("pmid", "url_scanner_score", "url_likelihood"), "pmid").groupBy("host", "norm_entity").agg(F.max(F.struct("url_scanner_score", "url_likelihood")).alias("_s"))
    own = F.nullif(F.trim(fx.filled("resource_url")), F.lit(""))
    j = merged.join(per, ["host", "norm_entity"], "left").join(best, ["host", "norm_entity"], "left")
    origin = F.when(own.isNotNull(), "original").when(F.col("_r").isNotNull(), "recovered").otherwise("none")
    return j.withColumn("url_origin", origin).withColumn("resource_url", F.coalesce(own, "_r")).withColumn("url_scanner_score", F.col("_s.url_scanner_score")).withColumn("url_likelihood", F.col("_s.url_likelihood")).drop("_r", "_s")


def finalise(merged: DataFrame, papers: DataFrame, countries: DataFrame) -> DataFrame:
    """The inventory: clean names told apart by sub-domain, triaged URLs, the papers' metadata and countries."""
    named = merged.select(
        F.col("pmid").alias("ID"), F.coalesce(F.nullif(F.trim("primary_entity_short"), F.lit("")), F.col("primary_entity_long")).alias("best_name"), F.col("primary_entity_short").alias("best_common"),
        F.col("primary_entity_long").alias("best_full"), F.col("ner_confidence").alias("best_name_prob"), "article_count", F.col("resource_url").alias("extracted_url"), "url_origin",
    )
    clean = R.positions(nx.sanitise(named, "best_name", "extracted_url"), ["ID", "extracted_url", "best_name"], "row").withColumn("url_validation", ux.triage("extracted_url"))
    told = nx.disambiguate(clean.withColumn("s", nx.subdomain_of("extracted_url")), "best_name", "name_modification_flags", "s").drop("s")
    one = R.keep_first(papers.filter("trim(coalesce(id, '')) <> ''"), ["id"], ["title", "abstract"])
    ids = told.select("row", F.explode(fx.paper_ids("ID")).alias("pmid")).distinct()
    facts = paper_facts(ids, one.withColumnRenamed("id", "pmid"))
    found = extract_countries(facts.select("row", "affiliation"), "row", "affiliation", countries).withColumnRenamed("countries", "affiliation_countries")
    out = told.join(facts.select("row", "publication_date", "affiliation", "num_citations", "paper_titles"), "row", "left").join(found, "row", "left")
    return layout(out.drop("row"), ["best_name_original", "name_modification_flags", "url_validation", "url_origin", "paper_titles"])


def stages(profiles: dict[str, dict] | None = None) -> list[Stage]:
    """The stages in order; profiles of a configuration take the place of the built-in ones."""
    known = X.PROFILES if profiles is None else profiles
    return [
        Stage(2, "entities", ("ner_union",), union_entities),
        Stage(3, "scored", ("papers", "entities"), score),
        Stage(4, "classified", ("scored", "known"), classify),
        Stage(5, "sets", ("scored", "classified"), paper_sets),
        Stage(5, "mapped", ("sets", "scored", "known"), primary),
        Stage(7, "dedup", ("mapped",), lambda mapped, profile: dedup(mapped, known[profile]), per_profile=True),
        Stage(6, "scanned", ("mapped", "scans"), scan),
        Stage(8, "recovered", ("mapped", "documents"), recover),
        Stage(9, "merged", ("dedup_{profile}", "recovered", "scanned"), lambda a, b, c, profile: merge(a, b, c), per_profile=True),
        Stage(9, "inventory", ("merged_{profile}", "papers", "countries"), lambda a, b, c, profile: finalise(a, b, c), per_profile=True),
    ]


STAGES = stages()
