"""Queries of scanning, URL recovery and the final inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resinv.functions import fixed as X
from resinv.functions import names as nx
from resinv.functions import text as fx
from resinv.functions import urls as ux
from resinv.operators import relational as R
from resinv.operators.countries import extract_countries, standard_country
from resinv.plans import sqltext as S
from resinv.plans.registry import query, table
from resinv.plans.views import papers, scans


# joins of scan results


@query(
    f"""WITH {S.SCANS} SELECT u.pmid, u.primary_score, coalesce(s.url_scanner_score, 0) AS url_scanner_score, coalesce(s.url_likelihood, 'NOT_SCANNED') AS url_likelihood,
 coalesce(s.url_scan_status, 'not_scanned') AS url_scan_status FROM union_papers_with_primary_resources u LEFT JOIN scans s USING (pmid)"""
)
def scan_join(spark: SparkSession, d: str) -> DataFrame:
    """Scan results joined to the papers, with defaults for papers never scanned."""
    u = table(spark, d, "union_papers_with_primary_resources").select("pmid", "primary_score")
    return R.lookup_default(u, scans(spark, d, "url_scanner_score", "url_likelihood", "url_scan_status"), "pmid", {"url_scanner_score": 0, "url_likelihood": "NOT_SCANNED", "url_scan_status": "not_scanned"})


_LIGHT = lambda c: rf"regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '^https?://', ''), '^www\.', ''), '/+$', '')"


@query(
    f"""WITH per AS (SELECT {_LIGHT('resource_url')} AS k, max(url_scanner_score) AS best, count(*) AS scans FROM papers_with_scanner_scores WHERE trim(coalesce(resource_url, '')) <> '' GROUP BY 1)
SELECT record_num, extracted_url, coalesce(best, 0) AS best_scan, coalesce(scans, 0) AS scans FROM final_inventory LEFT JOIN per ON k = {_LIGHT('extracted_url')} AND k <> ''"""
)
def scan_join_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Inventory records with the best scan of their URL, joined on its light normal form; one row a record."""
    per = table(spark, d, "papers_with_scanner_scores").filter("trim(coalesce(resource_url, '')) <> ''").groupBy(ux.normal_light("resource_url").alias("k")).agg(F.max("url_scanner_score").alias("best_scan"), F.count("*").alias("scans"))
    inv = table(spark, d, "final_inventory").select("record_num", "extracted_url").withColumn("k", ux.normal_light("extracted_url"))
    return inv.join(per.filter("k <> ''"), "k", "left").select("record_num", "extracted_url", F.coalesce("best_scan", F.lit(0)).alias("best_scan"), F.coalesce("scans", F.lit(0)).alias("scans"))


@query(
    f"""WITH {S.SCANS}, sets AS (SELECT pmid, 'a' AS name FROM union_papers_with_primary_resources WHERE in_linguistic UNION ALL SELECT pmid, 'b' FROM union_papers_with_primary_resources WHERE in_setfit
 UNION ALL SELECT pmid, 'c' FROM union_papers_with_primary_resources) SELECT name, count(*) AS papers, count(s.pmid) AS scanned, count(*) FILTER (url_scanner_score >= 10) AS likely,
 count(*) FILTER (url_scan_status = 'success') AS succeeded FROM sets LEFT JOIN scans s USING (pmid) GROUP BY name"""
)
def scan_backfill(spark: SparkSession, d: str) -> DataFrame:
    """One lookup joined once for three sets of papers."""
    u = table(spark, d, "union_papers_with_primary_resources").select("pmid", F.explode(F.array_compact(F.array(F.when(F.col("in_linguistic"), "a"), F.when(F.col("in_setfit"), "b"), F.lit("c")))).alias("name"))
    j = u.join(scans(spark, d, "url_scanner_score", "url_scan_status").withColumn("hit", F.lit(1)), "pmid", "left")
    return j.groupBy("name").agg(F.count("*").alias("papers"), F.count("hit").alias("scanned"), F.count_if(F.col("url_scanner_score") >= 10).alias("likely"), F.count_if(F.col("url_scan_status") == "success").alias("succeeded"))


# URL recovery

_IDS = r"regexp_extract_all(coalesce(ID, ''), '\b\d{7,8}\b')"
_URL_OK = f"extracted_url IS NOT NULL AND NOT {S.inlist('lower(trim(extracted_url))', X.BLANKS)} AND regexp_matches(extracted_url, '^[a-zA-Z]+://[^/]')"
_MISSING = f"(extracted_url IS NULL OR {S.inlist('lower(trim(extracted_url))', X.BLANKS)} OR extracted_url = 'http://')"


def records(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Inventory records with their list of papers."""
    return table(spark, d, "final_inventory").select(F.col("record_num").alias("row"), fx.paper_ids("ID").alias("ids"), *columns)


@query(f"SELECT record_num AS row, array_to_string(list_sort(list_distinct({_IDS})), ',') AS pmids, CAST(len({_IDS}) AS INTEGER) AS papers FROM final_inventory WHERE {_MISSING}")
def missing_urls(spark: SparkSession, d: str) -> DataFrame:
    """Records without a usable URL, with the papers in which one may stand."""
    r = records(spark, d, "extracted_url").filter(fx.is_blank("extracted_url") | (F.col("extracted_url") == "http://"))
    return r.select("row", F.array_join(F.array_sort(F.array_distinct("ids")), ",").alias("pmids"), F.size("ids").alias("papers"))


_RECOVERED = rf"""{S.PAPERS}, urls AS (SELECT id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(coalesce(abstract, ''), {S.q('(?i)(' + ux._RECOVERY + ')')}, 1),
 lambda u: regexp_replace(u, '[.,;:!?)\]}}]+$', '')), lambda u: length(u) > 8))), '|') AS u FROM papers),
texts AS (SELECT pmid AS id, array_to_string(list_sort(list_distinct(flatten(list(list_filter(list_transform(regexp_extract_all(coalesce(text, ''), {S.q('(?i)(' + ux._RECOVERY + ')')}, 1),
 lambda u: regexp_replace(u, '[.,;:!?)\]}}]+$', '')), lambda u: length(u) > 8))))), '|') AS u FROM documents WHERE pmid IS NOT NULL GROUP BY pmid),
miss AS (SELECT record_num AS row, {_IDS} AS ids FROM final_inventory WHERE {_MISSING}),
ex AS (SELECT row, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS pos FROM miss),
ab AS (SELECT row, arg_min(u, (pos, u)) AS hit, arg_min(id, (pos, u)) AS hit_key FROM ex JOIN urls USING (id) WHERE u <> '' GROUP BY row),
ft AS (SELECT row, arg_min(u, (pos, u)) AS hit, arg_min(id, (pos, u)) AS hit_key FROM ex JOIN texts USING (id) WHERE u <> '' GROUP BY row)"""


def _missing(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d, "extracted_url").filter(fx.is_blank("extracted_url") | (F.col("extracted_url") == "http://")).select("row", "ids")


def _abstract_urls(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "abstract").select("id", F.nullif(F.array_join(ux.extract_urls_recovery("abstract"), "|"), F.lit("")).alias("u"))


def _text_urls(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").filter("pmid is not null").select(F.col("pmid").alias("id"), F.explode(ux.extract_urls_recovery("text")).alias("u"))
    return t.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("u")), "|").alias("u"))


@query(f"WITH {_RECOVERED} SELECT m.row, hit, hit_key FROM miss m LEFT JOIN ab USING (row)")
def recover_first_hit(spark: SparkSession, d: str) -> DataFrame:
    """For each record the URLs of the first of its papers whose abstract has any."""
    return R.first_hit(_missing(spark, d), F.col("ids"), _abstract_urls(spark, d), "id", "u").select("row", "hit", "hit_key")


@query(f"WITH {_RECOVERED} SELECT m.row, coalesce(ab.hit, ft.hit) AS found_urls, CASE WHEN ab.hit IS NOT NULL THEN 'abstract' WHEN ft.hit IS NOT NULL THEN 'fulltext' ELSE 'not_available' END AS url_source FROM miss m LEFT JOIN ab USING (row) LEFT JOIN ft USING (row)")
def recover_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """The abstract's hit, else the full text's, else none."""
    m = _missing(spark, d)
    a = R.first_hit(m, F.col("ids"), _abstract_urls(spark, d), "id", "u").select("row", F.col("hit").alias("a"))
    f = R.first_hit(m, F.col("ids"), _text_urls(spark, d), "id", "u").select("row", F.col("hit").alias("f"))
    source = F.when(F.col("a").isNotNull(), "abstract").when(F.col("f").isNotNull(), "fulltext").otherwise("not_available")
    return a.join(f, "row").select("row", F.coalesce("a", "f").alias("found_urls"), source.alias("url_source"))


@query(
    f"""WITH {_RECOVERED}, al AS (SELECT row, hit AS found_urls, 'abstract' AS url_source, 0 AS p FROM ab UNION ALL SELECT row, hit, 'fulltext', 1 FROM ft UNION ALL SELECT row, NULL, 'not_available', 3 FROM miss)
SELECT row, found_urls, url_source FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY p, found_urls) AS rn FROM al) WHERE rn = 1"""
)
def recover_priority(spark: SparkSession, d: str) -> DataFrame:
    """Results of several sources as one table, the best source first, one row a record."""
    m = _missing(spark, d)
    part = lambda t, s: R.first_hit(m, F.col("ids"), t, "id", "u").filter("hit is not null").select("row", F.col("hit").alias("found_urls"), F.lit(s).alias("url_source"))
    rows = part(_abstract_urls(spark, d), "abstract").unionByName(part(_text_urls(spark, d), "fulltext")).unionByName(m.select("row", F.lit(None).cast("string").alias("found_urls"), F.lit("not_available").alias("url_source")))
    order = F.when(F.col("url_source") == "abstract", 0).when(F.col("url_source") == "fulltext", 1).when(F.col("url_source") == "web_search", 2).otherwise(3)
    return R.keep_first(rows, ["row"], [order, "found_urls"])


@query(
    f"""WITH {_RECOVERED} SELECT record_num AS row, CASE WHEN NOT {_MISSING} THEN extracted_url WHEN coalesce(ab.hit, ft.hit) IS NOT NULL THEN string_split(coalesce(ab.hit, ft.hit), '|')[1] END AS url,
 CASE WHEN NOT {_MISSING} THEN 'original' WHEN coalesce(ab.hit, ft.hit) IS NOT NULL THEN 'recovered' ELSE 'none' END AS origin FROM final_inventory i LEFT JOIN ab ON ab.row = i.record_num LEFT JOIN ft ON ft.row = i.record_num"""
)
def inventory_url_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The record's own URL, else the recovered one, else none."""
    inv = table(spark, d, "final_inventory").select(F.col("record_num").alias("row"), "extracted_url")
    found = recover_coalesce(spark, d).filter("found_urls is not null").select("row", F.split("found_urls", "[|]")[0].alias("r"))
    j = inv.join(found, "row", "left")
    own = ~(fx.is_blank("extracted_url") | (F.col("extracted_url") == "http://"))
    return j.select("row", F.when(own, F.col("extracted_url")).otherwise(F.col("r")).alias("url"), F.when(own, "original").when(F.col("r").isNotNull(), "recovered").otherwise("none").alias("origin"))


@query(
    f"""WITH {S.SCANS}, m AS (SELECT record_num AS row, unnest(list_distinct({_IDS})) AS pmid FROM final_inventory),
f AS (SELECT row, array_to_string(list_sort(list_distinct(list(resource_url))), ' | ') AS urls FROM m JOIN scans USING (pmid) WHERE resource_url IS NOT NULL GROUP BY row)
SELECT i.record_num AS row, coalesce(urls, '') AS urls FROM final_inventory i LEFT JOIN f ON f.row = i.record_num"""
)
def pmid_url_explode_join(spark: SparkSession, d: str) -> DataFrame:
    """All URLs scanned for any of a record's papers, as a sorted set."""
    out = R.list_lookup(records(spark, d), F.col("ids"), scans(spark, d, "resource_url"), "pmid", "resource_url")
    return out.select("row", F.array_join("found", " | ").alias("urls"))


@query("SELECT record_num, CAST(ntile(7) OVER (ORDER BY record_num) AS BIGINT) AS chunk FROM final_inventory")
def websearch_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Seven chunks of nearly equal size, in record order."""
    return R.chunk_numbers(table(spark, d, "final_inventory").select("record_num"), ["record_num"], 7)


# finalisation


@query()
def name_sanitise(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned names with the flags of what was done."""
    f = table(spark, d, "final_inventory").select("record_num", "best_name", "extracted_url")
    return nx.sanitise(f, "best_name", "extracted_url").select("record_num", "best_name", "best_name_original", "name_modification_flags")


_PLAIN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(n1, '<[^>]+>', '', 'g'), '^[a-zA-Z]+>', ''), '</[a-zA-Z]+$', ''), '/[a-zA-Z]+$', ''), '[<>]', '', 'g'))"""


@query(
    f"""WITH a AS (SELECT record_num, coalesce(best_name, '') AS n0, CASE WHEN contains(coalesce(best_name, ''), '|') THEN trim(split_part(best_name, '|', 1)) ELSE coalesce(best_name, '') END AS n1 FROM final_inventory),
b AS (SELECT record_num, n0, n1, {_PLAIN} AS n2 FROM a)
SELECT record_num, n2 AS name, CASE WHEN regexp_matches(trim(n2), '^[a-z]{{1,6}}$') THEN upper(trim(n2)) ELSE trim(n2) END AS capital, n2 <> n1 AS changed,
 CASE WHEN suffix(lower(n2), 'db') OR suffix(lower(n2), 'base') THEN 'database' ELSE 'other' END AS kind FROM b"""
)
def name_clean(spark: SparkSession, d: str) -> DataFrame:
    """The steps of name cleaning that SQL can express: pipes, tags, capitals."""
    f = table(spark, d, "final_inventory").select("record_num", "best_name").withColumn("n1", nx.first_of_pipes("best_name")).withColumn("n2", nx.without_tags(F.col("n1")))
    low = F.lower("n2")
    return f.select("record_num", F.col("n2").alias("name"), nx.auto_capital(F.col("n2")).alias("capital"), (F.col("n2") != F.col("n1")).alias("changed"), F.when(low.endswith("db") | low.endswith("base"), "database").otherwise("other").alias("kind"))


_SEG = r"list_filter(string_split(regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', ''), '/'), lambda s: s <> '' AND NOT starts_with(s, '~'))"


@query(
    rf"""WITH a AS (SELECT record_num, trim(coalesce(extracted_url, '')) AS u FROM final_inventory),
b AS (SELECT record_num, list_filter(list_transform({_SEG}, lambda s: regexp_replace(split_part(split_part(s, '?', 1), '=', 1), '(?i)\.(php|html|aspx|jsp|htm)$', '')), lambda s: NOT {S.inlist('lower(s)', X.SKIP_SEGMENTS)} AND length(s) > 1) AS t,
 replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), 'www.', '') AS h FROM a),
c AS (SELECT *, string_split(h, '.')[1] AS l FROM b)
SELECT record_num, coalesce(list_filter(t, lambda s: regexp_matches(s, '[a-z]') AND regexp_matches(s, '[A-Z]'))[1], list_filter(t, lambda s: s = upper(s) AND s <> lower(s) AND length(s) >= 3)[1],
 CASE WHEN length(t[-1]) >= 3 THEN t[-1] END, CASE WHEN contains(h, '.') AND NOT {S.inlist('lower(l)', X.SKIP_SEGMENTS)} AND length(l) >= 3 THEN l END, regexp_replace(l, '[^a-zA-Z0-9]', '', 'g'), '') AS name FROM c"""
)
def name_from_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "final_inventory").select("record_num", nx.name_from_url("extracted_url").alias("name"))


_IN_URL = r"""(n <> '' AND u <> '' AND (contains(u, n) OR (length(k) >= 3 AND contains(u, k)) OR (length(n) >= 5 AND regexp_matches(n[1:5], '^[\p{L}\p{N}]+$') AND contains(u, n[1:5]))))"""


@query(
    rf"""WITH a AS (SELECT record_num, lower(coalesce(best_name, '')) AS n, lower(coalesce(extracted_url, '')) AS u FROM final_inventory),
b AS (SELECT *, regexp_replace(regexp_replace(n, '[-_]?(db|base|database|server|portal|tool|hub)$', ''), '^[-_]+|[-_]+$', '', 'g') AS k FROM a) SELECT record_num, {_IN_URL} AS in_url FROM b"""
)
def name_in_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "final_inventory").select("record_num", nx.in_url(F.col("best_name"), "extracted_url").alias("in_url"))


_SUB = f"CASE WHEN len(p) >= 3 AND NOT {S.inlist('lower(p[1])', X.SKIP_SUBDOMAINS)} AND length(p[1]) >= 3 THEN p[1] ELSE '' END"


@query(
    rf"""WITH a AS (SELECT record_num, coalesce(best_name, '') AS n, coalesce(name_modification_flags, '') AS f, string_split(regexp_extract(trim(coalesce(extracted_url, '')), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '.') AS p FROM final_inventory),
b AS (SELECT *, {_SUB} AS s, count(*) OVER (PARTITION BY n) AS c FROM a), d AS (SELECT *, c > 1 AND s <> '' AND lower(s) <> lower(n) AS t FROM b)
SELECT record_num, CASE WHEN t THEN n || ' (' || s || ')' ELSE n END AS best_name, CASE WHEN t THEN CASE WHEN f <> '' THEN f || ',DISAMBIGUATED' ELSE 'DISAMBIGUATED' END ELSE f END AS name_modification_flags FROM d"""
)
def name_disambiguate(spark: SparkSession, d: str) -> DataFrame:
    """Records of one name told apart by their sub-domain."""
    f = table(spark, d, "final_inventory").select("record_num", fx.filled("best_name").alias("n"), fx.filled("name_modification_flags").alias("f"), nx.subdomain_of("extracted_url").alias("s"))
    return nx.disambiguate(f, "n", "f", "s").select("record_num", F.col("n").alias("best_name"), F.col("f").alias("name_modification_flags"))


_CASED = "array_to_string(list_transform(regexp_split_to_array(trim(n), '\\s+'), lambda w: CASE WHEN w = lower(w) AND regexp_matches(w, '[a-z]') THEN upper(w[1]) || w[2:] ELSE w END), ' ')"


@query(
    f"""WITH {S.PAPERS}, i AS (SELECT record_num, coalesce(best_name, '') AS n, unnest(CASE WHEN len({_IDS}) = 0 THEN [NULL] ELSE {_IDS} END) AS pmid FROM final_inventory),
pos AS (SELECT *, row_number() OVER (PARTITION BY record_num ORDER BY pmid) AS o FROM i),
h AS (SELECT record_num, n, o, CASE WHEN length(n) >= 3 AND instr(lower(coalesce(title, '')), lower(n)) > 0 THEN substr(title, CAST(instr(lower(title), lower(n)) AS INTEGER), CAST(length(n) AS INTEGER)) END AS hit FROM pos LEFT JOIN papers ON id = pmid),
b AS (SELECT record_num, n, arg_min(hit, (o, hit)) FILTER (hit IS NOT NULL AND hit <> lower(hit)) AS best FROM h GROUP BY record_num, n)
SELECT record_num, coalesce(best, {_CASED}) AS best_name, CASE WHEN best IS NOT NULL AND best <> n THEN 'TITLE_CAPITALIZED' WHEN best IS NULL AND {_CASED} <> n THEN 'SMART_CAPITALIZED' ELSE '' END AS flag FROM b"""
)
def title_capitalise(spark: SparkSession, d: str) -> DataFrame:
    """A name as its first paper's title writes it, else with capitals for all-lower words."""
    f = records(spark, d, fx.filled("best_name").alias("n")).select("row", "n", F.explode_outer(F.array_sort("ids")).alias("pmid"))
    j = f.join(papers(spark, d, "title").withColumnRenamed("id", "pmid"), "pmid", "left")
    at = F.position(F.lower("n"), F.lower(fx.filled("title")))
    hit = F.when((F.length("n") >= 3) & (at > 0), F.substring("title", at, F.length("n")))
    j = j.withColumn("hit", hit).withColumn("hit", F.when(F.col("hit") != F.lower("hit"), F.col("hit")))
    b = j.groupBy("row", "n").agg(F.min(F.when(F.col("hit").isNotNull(), F.struct("pmid", "hit")))["hit"].alias("best"))
    cased = fx.smart_title_case("n")
    flag = F.when(F.col("best").isNotNull() & (F.col("best") != F.col("n")), "TITLE_CAPITALIZED").when(F.col("best").isNull() & (cased != F.col("n")), "SMART_CAPITALIZED").otherwise("")
    return b.select(F.col("row").alias("record_num"), F.coalesce("best", cased).alias("best_name"), flag.alias("flag"))


@query(
    f"""WITH {S.PAPERS}, i AS (SELECT DISTINCT record_num, unnest({_IDS}) AS pmid FROM final_inventory),
j AS (SELECT record_num, pmid, nullif(trim(publication_date), '') AS dt, nullif(trim(authorAffiliations), '') AS aff, title, coalesce(citedByCount, 0) AS c, keywords FROM i LEFT JOIN papers ON id = pmid)
SELECT record_num, min(dt) AS publication_date, coalesce(string_agg(aff, '; ' ORDER BY pmid, aff), '') AS affiliation, nullif(CAST(sum(c) AS BIGINT), 0) AS num_citations,
 coalesce(string_agg(title, ' | ' ORDER BY pmid, title), '') AS paper_titles, count(*) AS papers,
 array_to_string(list_sort(list_distinct(list_filter(flatten(list(CASE WHEN starts_with(trim(keywords), '[') AND json_valid(keywords) THEN CAST(keywords AS VARCHAR[]) ELSE [] END)), lambda e: e IS NOT NULL))), ', ') AS keywords FROM j GROUP BY record_num"""
)
def metadata_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of all papers of a record: first date, affiliations and titles in order, summed citations, distinct keywords."""
    i = records(spark, d).select("row", F.explode(F.array_distinct("ids")).alias("pmid"))
    p = papers(spark, d, "publication_date", "authorAffiliations", "title", "citedByCount", "keywords").withColumnRenamed("id", "pmid")
    return paper_facts(i, p, F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(fx.json_list("keywords"))))), ", ").alias("keywords"), F.count("*").alias("papers")).withColumnRenamed("row", "record_num")


def paper_facts(ids: DataFrame, papers: DataFrame, *more: Column) -> DataFrame:
    """Per ``row`` of (row, pmid) the papers' first date, affiliations and titles in order, and citations in all."""
    order = F.struct("pmid")
    return ids.join(papers, "pmid", "left").groupBy("row").agg(
        F.min(F.nullif(F.trim("publication_date"), F.lit(""))).alias("publication_date"), R.ordered_join(F.nullif(F.trim("authorAffiliations"), F.lit("")), order, "; ").alias("affiliation"),
        F.nullif(F.sum(F.coalesce("citedByCount", F.lit(0))), F.lit(0)).alias("num_citations"), R.ordered_join(F.col("title"), order, " | ").alias("paper_titles"), *more,
    )


def _countries_sql(out: str) -> str:
    cases = " ".join(f"UNION ALL SELECT record_num, {S.q(full)} FROM final_inventory WHERE regexp_matches(coalesce(affiliation, ''), '\\b{short}\\b')" for short, full in X.COUNTRY_ABBREVIATIONS.items())
    return f"""WITH a AS (SELECT record_num, ' ' || regexp_replace(lower(coalesce(affiliation, '')), '[^a-z0-9]+', ' ', 'g') || ' ' AS t FROM final_inventory),
k AS (SELECT name, {out} AS o, ' ' || trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) || ' ' AS n, ' ' || lower(alpha3) || ' ' AS c FROM country_list),
ab AS (SELECT NULL::BIGINT AS record_num, '' AS name WHERE false {cases}),
f AS (SELECT record_num, o FROM a, k WHERE contains(t, n) OR contains(t, c) UNION SELECT record_num, o FROM ab JOIN k ON trim(k.n) = lower(ab.name))
SELECT i.record_num, coalesce(string_agg(o, ', ' ORDER BY o), '') AS countries FROM final_inventory i LEFT JOIN f USING (record_num) GROUP BY i.record_num"""


@query(_countries_sql("name"))
def countries_extract(spark: SparkSession, d: str) -> DataFrame:
    """Countries named by name, alpha-3 code or cased abbreviation in an affiliation."""
    return extract_countries(table(spark, d, "final_inventory").select("record_num", "affiliation"), "record_num", "affiliation", table(spark, d, "country_list"))


@query(_countries_sql("alpha2"))
def countries_extract_alpha2(spark: SparkSession, d: str) -> DataFrame:
    """The same as alpha-2 codes."""
    return extract_countries(table(spark, d, "final_inventory").select("record_num", "affiliation"), "record_num", "affiliation", table(spark, d, "country_list"), "alpha-2")


def _url_country_sql(out: str) -> str:
    return f"""WITH k AS (SELECT *, string_split(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM country_list),
i AS (SELECT record_num, extracted_url_country AS s, trim(regexp_replace(lower(coalesce(extracted_url_country, '')), '[^a-z0-9]+', ' ', 'g')) AS p FROM final_inventory),
whole AS (SELECT record_num, arg_min({out}, name) AS o FROM i JOIN country_list ON upper(trim(s)) IN (upper(alpha2), upper(alpha3), upper(name)) GROUP BY 1),
part AS (SELECT record_num, arg_min({out}, (strpos(' ' || array_to_string(w, ' ') || ' ', ' ' || p || ' '), name)) AS o FROM i JOIN k ON p <> '' AND contains(' ' || array_to_string(w, ' ') || ' ', ' ' || p || ' ') GROUP BY 1)
SELECT i.record_num, coalesce(whole.o, part.o, nullif(trim(s), ''), '') AS country FROM i LEFT JOIN whole USING (record_num) LEFT JOIN part USING (record_num)"""


@query(_url_country_sql("name"))
def url_country(spark: SparkSession, d: str) -> DataFrame:
    """The country of a URL by code, name or part of a name, as stored if unknown."""
    return standard_country(table(spark, d, "final_inventory"), "record_num", "extracted_url_country", table(spark, d, "country_list"))


@query(_url_country_sql("alpha3"))
def url_country_alpha3(spark: SparkSession, d: str) -> DataFrame:
    """The same as alpha-3 codes."""
    return standard_country(table(spark, d, "final_inventory"), "record_num", "extracted_url_country", table(spark, d, "country_list"), "alpha-3")


# side outputs for people


@query("SELECT record_num, best_name, best_name_original, name_modification_flags FROM final_inventory WHERE coalesce(name_modification_flags, '') <> ''")
def review_modified_names(spark: SparkSession, d: str) -> DataFrame:
    """Records whose name was changed."""
    return R.review_parts(table(spark, d, "final_inventory"))["modified_names"].select("record_num", "best_name", "best_name_original", "name_modification_flags")


@query("SELECT record_num, extracted_url, url_validation FROM final_inventory WHERE url_validation = 'review'")
def review_urls(spark: SparkSession, d: str) -> DataFrame:
    """Records whose URL a person should look at."""
    return R.review_parts(table(spark, d, "final_inventory"))["urls_to_review"].select("record_num", "extracted_url", "url_validation")


@query("SELECT record_num, best_name, extracted_url FROM final_inventory WHERE trim(coalesce(extracted_url, '')) = ''")
def review_excluded(spark: SparkSession, d: str) -> DataFrame:
    """Records left out for want of a URL."""
    return R.review_parts(table(spark, d, "final_inventory"))["excluded"].select("record_num", "best_name", "extracted_url")


@query(f"""WITH u AS (SELECT extracted_url AS url, min(record_num) AS record_num FROM final_inventory WHERE {_URL_OK} GROUP BY 1),
h AS (SELECT *, {S.host("url")} AS host FROM u)
SELECT row_number() OVER (ORDER BY record_num) AS url_id, url, record_num, host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM h""")
def scan_list(spark: SparkSession, d: str) -> DataFrame:
    """The URLs to scan: each once, under its first record, numbered in that order, with host and path."""
    rows = table(spark, d, "final_inventory").select("record_num", F.col("extracted_url").alias("url")).filter(~fx.is_blank("url") & F.col("url").rlike("^[a-zA-Z]+://[^/]"))
    once = rows.groupBy("url").agg(F.min("record_num").alias("record_num"))
    parts = once.select("url", "record_num", ux.authority("url").alias("host"), F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"))
    return R.positions(parts, ["record_num"], "url_id")


@query("WITH c AS (SELECT trim(unnest(regexp_split_to_array(affiliation_countries, '[,;]'))) AS country FROM final_inventory) SELECT country, count(*) AS n FROM c WHERE country <> '' GROUP BY country ORDER BY n DESC, country LIMIT 10")
def top_countries(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "final_inventory").select(F.explode(fx.split_list("affiliation_countries", ",;")).alias("country"))
    return c.groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(10)


@query("WITH f AS (SELECT trim(unnest(string_split(name_modification_flags, ','))) AS flag FROM final_inventory) SELECT flag, count(*) AS n FROM f WHERE flag <> '' GROUP BY flag")
def flag_token_counts(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "final_inventory").select(F.explode(fx.split_list("name_modification_flags")).alias("flag"))
    return f.groupBy("flag").agg(F.count("*").alias("n"))


@query(f"SELECT record_num, CAST(len({_IDS}) AS INTEGER) AS papers FROM final_inventory")
def csv_list_count(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select(F.col("row").alias("record_num"), F.size("ids").alias("papers"))


# The columns of the inventory, in order.
INVENTORY_COLUMNS = [
    "ID", "best_name", "best_name_prob", "best_common", "best_common_prob", "best_full", "best_full_prob", "article_count", "extracted_url", "extracted_url_status",
    "extracted_url_country", "extracted_url_coordinates", "wayback_url", "publication_date", "affiliation", "authors", "grant_ids", "grant_agencies", "num_citations", "affiliation_countries",
]
_NUMBERS = {"best_name_prob": "double", "best_common_prob": "double", "best_full_prob": "double", "article_count": "int", "num_citations": "bigint"}


@query("SELECT record_num, " + ", ".join(c if c in _NUMBERS else f"coalesce({c}, '') AS {c}" for c in INVENTORY_COLUMNS) + " FROM final_inventory")
def final_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The inventory in its target layout: all columns there, numbers as numbers, blanks for missing text."""
    return layout(table(spark, d, "final_inventory"), ["record_num"])


def layout(df: DataFrame, keys: list[str]) -> DataFrame:
    """Any table in the layout of the inventory; missing columns are added empty, unreadable numbers are null."""
    out = [F.col(k) for k in keys]
    for c in INVENTORY_COLUMNS:
        have = F.col(c) if c in df.columns else F.lit(None)
        out.append((have.try_cast(_NUMBERS[c]) if c in _NUMBERS else F.coalesce(have.cast("string"), F.lit(""))).alias(c))
    return df.select(*out)


@query(
    """SELECT count(*) AS records, count(*) FILTER (trim(coalesce(extracted_url, '')) <> '') AS with_url, count(*) FILTER (extracted_url_status = '200') AS live, count(*) FILTER (trim(coalesce(best_full, '')) <> '') AS with_full_name,
 avg(article_count) AS mean_papers, CAST(max(article_count) AS INTEGER) AS most_papers, median(num_citations) AS median_citations, stddev_samp(CAST(num_citations AS DOUBLE)) AS spread_citations, count(DISTINCT best_name) AS names FROM final_inventory"""
)
def final_statistics(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "final_inventory")
    return f.agg(
        F.count("*").alias("records"), F.count_if(F.trim(fx.filled("extracted_url")) != "").alias("with_url"), F.count_if(F.col("extracted_url_status") == "200").alias("live"),
        F.count_if(F.trim(fx.filled("best_full")) != "").alias("with_full_name"), F.avg("article_count").alias("mean_papers"), F.max("article_count").alias("most_papers"),
        F.percentile("num_citations", 0.5).alias("median_citations"), F.stddev_samp("num_citations").alias("spread_citations"), F.countDistinct("best_name").alias("names"),
    )


# validation


@query(
    """SELECT count(*) AS papers, count(*) - count(DISTINCT pmid) AS repeated, count(*) FILTER (status = 'ok' AND trim(coalesce(primary_entity_long, '')) = '' AND trim(coalesce(primary_entity_short, '')) = '') AS ok_without_name,
 count(*) FILTER (status = 'no_entities' AND (trim(coalesce(primary_entity_long, '')) <> '' OR trim(coalesce(primary_entity_short, '')) <> '')) AS none_with_name,
 count(*) FILTER (primary_score < 0 OR primary_score > 25) AS score_out_of_range, count(*) FILTER (status NOT IN ('ok', 'conflict', 'low_score', 'no_entities')) AS unknown_status FROM union_papers_with_primary_resources"""
)
def validate_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Rules that the mapping must keep, counted in one pass."""
    u = table(spark, d, "union_papers_with_primary_resources")
    named = (F.trim(fx.filled("primary_entity_long")) != "") | (F.trim(fx.filled("primary_entity_short")) != "")
    return u.agg(
        F.count("*").alias("papers"), (F.count("*") - F.countDistinct("pmid")).alias("repeated"), F.count_if((F.col("status") == "ok") & ~named).alias("ok_without_name"),
        F.count_if((F.col("status") == "no_entities") & named).alias("none_with_name"), F.count_if((F.col("primary_score") < 0) | (F.col("primary_score") > 25)).alias("score_out_of_range"),
        F.count_if(~F.col("status").isin("ok", "conflict", "low_score", "no_entities")).alias("unknown_status"),
    )


@query("SELECT status AS value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM union_papers_with_primary_resources GROUP BY status")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.value_counts(table(spark, d, "union_papers_with_primary_resources"), "status")


@query(f"WITH {S.SCANS} SELECT u.pmid, u.status, s.url_scanner_score AS scan_url_scanner_score, s.resource_url AS scan_resource_url FROM union_papers_with_primary_resources u LEFT JOIN scans s USING (pmid)")
def scan_prefixed(spark: SparkSession, d: str) -> DataFrame:
    """Scan columns joined under a prefix."""
    u = table(spark, d, "union_papers_with_primary_resources").select("pmid", "status")
    return u.join(R.prefixed(scans(spark, d, "url_scanner_score", "resource_url"), "pmid", "scan_"), "pmid", "left")


@query(
    f"""WITH {S.PAPERS}, l AS (SELECT pmid, title, 0 AS r FROM union_papers_with_primary_resources WHERE in_linguistic UNION ALL SELECT id, title, 1 FROM papers),
k AS (SELECT pmid, title FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY r, title) AS rn FROM l) WHERE rn = 1)
SELECT s.pmid, k.title FROM (SELECT DISTINCT pmid FROM papers_with_scanner_scores) s LEFT JOIN k USING (pmid)"""
)
def lookup_priority(spark: SparkSession, d: str) -> DataFrame:
    """Titles of scanned papers, from the linguistic set where it has them, else from the harvest."""
    s = table(spark, d, "papers_with_scanner_scores").select("pmid").distinct()
    a = table(spark, d, "union_papers_with_primary_resources").filter("in_linguistic").select("pmid", "title")
    b = papers(spark, d, "title").withColumnRenamed("id", "pmid")
    return R.priority_lookup(s, [a, b], "pmid", ["title"])
