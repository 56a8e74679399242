"""Queries on URLs: parts, normal forms, triage, extraction, scoring, clustering, similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resinv.functions import fixed as X
from resinv.functions import text as fx
from resinv.functions import urls as ux
from resinv.operators.clusters import cross_host_clusters, host_clusters
from resinv.plans import sqltext as S
from resinv.plans.registry import query, table
from resinv.plans.views import papers

_URL = "coalesce(extracted_url, '')"
_FULL = f"u0 AS (SELECT record_num, {_URL} AS url, {S.with_scheme(_URL)} AS f FROM final_inventory)"


def _parts(flavour: str) -> str:
    match = flavour == "match"
    suffixes = X.COMPOUND_SUFFIXES_MATCH if match else X.COMPOUND_SUFFIXES_DEDUP
    host = f"regexp_replace({S.host('f')}, '^www\\.', '')" if match else S.host("f")
    path = "lower(regexp_replace(regexp_extract(f, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', ''))"
    if match:
        path = f"replace(replace({path}, '/index.html', ''), '/index.php', '')"
    dot = "" if match else "."
    none = "(f = '' OR n < 2)" if match else "f = ''"
    compound = f"(n >= 3 AND {S.inlist('p[n - 1]', suffixes)})"
    tld = f"CASE WHEN {compound} THEN '{dot}' || p[n - 1] || '.' || p[n] ELSE '{dot}' || p[n] END"
    domain = f"CASE WHEN {compound} THEN p[n - 2] WHEN n >= 2 THEN p[n - 1] ELSE h END"
    head = f"CASE WHEN {compound} THEN n - 3 WHEN n >= 2 THEN n - 2 ELSE 0 END"
    base = f", CASE WHEN {none} THEN '' ELSE ({domain}) || '.' || ({tld}) END AS base_domain" if match else ""
    return f"""WITH {_FULL}, u1 AS (SELECT *, {host} AS h, {path} AS path FROM u0),
u2 AS (SELECT *, string_split(h, '.') AS p, len(string_split(h, '.')) AS n FROM u1),
parts AS (SELECT record_num, url, CASE WHEN {none} THEN '' ELSE lower(regexp_extract(f, '^([A-Za-z]+)://', 1)) END AS protocol,
 CASE WHEN {none} THEN '' ELSE array_to_string(p[1:({head})], '.') END AS subdomain,
 CASE WHEN {none} THEN '' ELSE {domain} END AS domain, CASE WHEN {none} THEN '' ELSE {tld} END AS tld,
 CASE WHEN {none} THEN '' ELSE path END AS path, CASE WHEN {none} THEN '' ELSE h END AS full_domain{base} FROM u2)"""


def _inventory(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "final_inventory").select("record_num", "extracted_url", *more)


@query(f"{_parts('dedup')} SELECT * EXCLUDE (url) FROM parts")
def url_components(spark: SparkSession, d: str) -> DataFrame:
    return _inventory(spark, d).select("record_num", *[v.alias(k) for k, v in ux.url_components("extracted_url").items()])


@query(f"{_parts('match')} SELECT * EXCLUDE (url) FROM parts")
def url_components_match(spark: SparkSession, d: str) -> DataFrame:
    return _inventory(spark, d).select("record_num", *[v.alias(k) for k, v in ux.url_components("extracted_url", "match").items()])


_AGGRESSIVE = """CASE WHEN trim(url) = '' THEN '' ELSE CASE WHEN s <> '' THEN s || '.' ELSE '' END || domain || tld || path END"""


@query(
    rf"""{_parts('dedup')}, s AS (SELECT *, CASE WHEN subdomain = 'www' THEN '' ELSE regexp_replace(regexp_replace(subdomain, '\.www$', ''), '^www\.', '') END AS s FROM parts)
SELECT record_num, {S.normal_strict('url')} AS strict, regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '^www\.', ''), '/+$', '') AS light,
 {_AGGRESSIVE} AS aggressive FROM s"""
)
def url_normal_forms(spark: SparkSession, d: str) -> DataFrame:
    u = "extracted_url"
    return _inventory(spark, d).select("record_num", ux.normal_strict(u).alias("strict"), ux.normal_light(u).alias("light"), ux.normal_aggressive(u).alias("aggressive"))


@query(
    f"""{_parts('match')} SELECT record_num, {S.ends('base_domain', X.GENERIC_DOMAINS)} AS generic, {S.ends('full_domain', X.PLATFORMS)} AS platform,
 CASE WHEN {S.ends('full_domain', X.PLATFORMS)} THEN full_domain ELSE base_domain END AS effective_domain FROM parts"""
)
def effective_domain(spark: SparkSession, d: str) -> DataFrame:
    p = ux.url_components("extracted_url", "match")
    parts = _inventory(spark, d).select("record_num", p["base_domain"].alias("b"), p["full_domain"].alias("f"))
    return parts.select("record_num", ux.is_generic_domain(F.col("b")).alias("generic"), ux.is_platform(F.col("f")).alias("platform"), ux.effective_domain(F.col("f"), F.col("b")).alias("effective_domain"))


def _cases(expr: str, cases: list[tuple[str, str]], last: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expr}, {S.q(p)}) THEN {S.q(r)}" for p, r in cases) + f" ELSE {S.q(last)} END"


@query(
    f"""SELECT record_num, CASE WHEN {S.matched(f'lower({_URL})', X.BLOCKED_PATTERNS, False)} THEN 'blocked'
 WHEN {S.matched(f'lower({_URL})', X.REVIEW_PATTERNS, False)} THEN 'review' ELSE 'ok' END AS triage,
 CASE WHEN {_URL} IN ('', 'NOT_FOUND') THEN '' ELSE {_cases(f'lower({_URL})', X.EXCLUSION_REASONS, '')} END AS reason,
 extracted_url IS NULL OR {S.inlist('lower(trim(extracted_url))', X.BLANKS)} AS missing FROM final_inventory"""
)
def url_triage(spark: SparkSession, d: str) -> DataFrame:
    """Blocked / review / ok, the reason of exclusion, and whether there is a URL at all."""
    u = "extracted_url"
    return _inventory(spark, d).select("record_num", ux.triage(u).alias("triage"), ux.exclusion_reason(u).alias("reason"), fx.is_blank(u).alias("missing"))


_DEAD = "NOT coalesce(extracted_url_status, '') IN ('200', '301', '302')"


@query(
    f"""SELECT record_num, ({S.matched(f'lower({_URL})', X.BLOCKED_PATTERNS, False)} OR extracted_url IS NULL OR {S.inlist('lower(trim(extracted_url))', X.BLANKS)}
 OR ({_DEAD} AND trim(coalesce(wayback_url, '')) = '')) AS excluded FROM final_inventory"""
)
def row_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a usable URL: blocked, missing, or dead without an archived copy."""
    dead = ~F.coalesce("extracted_url_status", F.lit("")).isin("200", "301", "302") & (F.trim(fx.filled("wayback_url")) == "")
    rows = _inventory(spark, d, "extracted_url_status", "wayback_url")
    return rows.select("record_num", ((ux.triage("extracted_url") == "blocked") | fx.is_blank("extracted_url") | dead).alias("excluded"))


def _recovery_sql() -> str:
    u, n = "lower(url)", "lower(name)"
    cases = [f"WHEN contains({u}, {S.q(x)}) THEN {S.q('excluded_domain:' + x)}" for x in X.RECOVERY_EXCLUDED]
    cases.append(f"WHEN starts_with({u}, 'ftp://') THEN 'ftp_protocol'")
    for x in X.REFERENCE_DATABASES:
        cases.append(f"WHEN contains({u}, {S.q(x)}) THEN CASE WHEN {n} <> '' AND contains({u}, {n}) THEN '' ELSE {S.q('reference_db:' + x)} END")
    for x in X.INSTITUTIONAL:
        cases.append(f"WHEN (suffix({u}, {S.q(x)}) OR NOT contains({u}, {S.q(x + '/')})) AND contains({u}, {S.q(x)}) AND NOT contains(list_extract(string_split({u}, {S.q(x)}), -1), '/') THEN {S.q('generic_institutional:' + x)}")
    return "CASE " + " ".join(cases) + " ELSE '' END"


@query(
    f"""WITH named AS (SELECT record_num, coalesce(extracted_url, '') AS url, coalesce(best_name, '') AS name FROM final_inventory)
SELECT record_num, url, {_recovery_sql()} AS recovery_reason, CASE WHEN url = '' THEN '' ELSE {_cases('lower(url)', X.EXCLUSION_REASONS, '')} END AS reason,
 CASE WHEN {S.matched('lower(url)', X.BLOCKED_PATTERNS, False)} THEN 'blocked' WHEN {S.matched('lower(url)', X.REVIEW_PATTERNS, False)} THEN 'review' ELSE 'ok' END AS triage,
 {S.some(f"regexp_replace(CASE WHEN {S.host('url')} = '' THEN lower(url) ELSE {S.host('url')} END, '^www.', '')", X.EXCLUDED_DOMAINS)} AS excluded_domain FROM named"""
)
def url_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every rule list on every record's URL."""
    named = _inventory(spark, d, "best_name").select("record_num", fx.filled("extracted_url").alias("url"), fx.filled("best_name").alias("name"))
    return named.select("record_num", "url", ux.recovery_reason("url", "name").alias("recovery_reason"), ux.exclusion_reason("url").alias("reason"), ux.triage("url").alias("triage"), ux.is_excluded_domain("url").alias("excluded_domain"))


_A = "coalesce(abstract, '')"
_TAKE = lambda p: f"regexp_extract_all({_A}, {S.q('(?i)(' + p + ')')}, 1)"
_PHRASED = ", ".join(f"regexp_extract_all({_A}, {S.q('(?i)' + p + chr(92) + 's+(' + ux._BARE + ')')}, 1)" for p in X.CONTEXT_PHRASES)
_EXTRACTED = rf"""{S.PAPERS}, found AS (SELECT id, {_A} AS a, flatten([{_TAKE(ux._HTTP)}, {_TAKE(ux._WWW)}, {_TAKE(ux._FTP)}, {_PHRASED}]) AS r FROM papers),
clean AS (SELECT id, a, list_transform(r, lambda u: regexp_replace(regexp_replace(u, '[.,;:)\]]+$', ''), '^[\[\](){{}}]+|[\[\](){{}}]+$', '', 'g')) AS r FROM found),
kept AS (SELECT id, a, list_transform(list_filter(r, lambda u: NOT (contains(u, '@') AND NOT starts_with(u, 'http')) AND length(u) >= 8),
 lambda u: CASE WHEN starts_with(u, 'www.') THEN 'http://' || u ELSE u END) AS r FROM clean),
urls AS (SELECT id, a, list_filter(r, lambda u, i: list_position(list_transform(r, lambda y: lower(y)), lower(u)) = i) AS urls FROM kept)"""


@query(f"WITH {_EXTRACTED} SELECT id, CAST(len(urls) AS INTEGER) AS n, array_to_string(urls, ' | ') AS urls FROM urls")
def url_extract(spark: SparkSession, d: str) -> DataFrame:
    """The URLs of every abstract, in order, without repeats."""
    found = papers(spark, d, "abstract").select("id", ux.extract_urls("abstract").alias("urls"))
    return found.select("id", F.size("urls").alias("n"), F.array_join("urls", " | ").alias("urls"))


_HOST = f"CASE WHEN {S.host('url')} = '' THEN lower(url) ELSE {S.host('url')} END"
_SCORED = f"""WITH {_EXTRACTED}, each AS (SELECT id, a, unnest(urls) AS url, generate_subscripts(urls, 1) AS pos FROM urls),
placed AS (SELECT *, instr(lower(a), lower(url)) AS hit, length(a) AS la, length(url) AS lu FROM each),
cut AS (SELECT *, greatest(0, hit - 51) AS b, least(la, hit - 1 + lu + 50) AS e FROM placed),
ctx AS (SELECT *, CASE WHEN hit = 0 THEN '' ELSE CASE WHEN b > 0 THEN '...' ELSE '' END || trim(substr(a, CAST(b AS INTEGER) + 1, CAST(e - b AS INTEGER))) || CASE WHEN e < la THEN '...' ELSE '' END END AS context FROM cut),
scored AS (SELECT id, url, pos, context, CASE WHEN {S.some(f"regexp_replace({_HOST}, '^www.', '')", X.EXCLUDED_DOMAINS)} THEN -1000.0 ELSE
 CASE WHEN {S.some('lower(context)', X.CONTEXT_PHRASES)} THEN 10 ELSE 0 END + CASE WHEN {S.some('lower(url)', X.RESOURCE_KEYWORDS)} THEN 8 ELSE 0 END
 + CASE WHEN {S.some('lower(url)', X.ACADEMIC_TLDS)} THEN 5 ELSE 0 END + CASE WHEN {S.some(_HOST, X.RESOURCE_SUBDOMAINS)} THEN 3 ELSE 0 END
 + CASE WHEN hit > 0 AND hit - 1 < la / 2.0 THEN 2 ELSE 0 END END AS score FROM ctx)"""


@query(f"{_SCORED} SELECT id, url, CAST(pos AS INTEGER) AS pos, CAST(score AS DOUBLE) AS score, context FROM scored")
def url_score(spark: SparkSession, d: str) -> DataFrame:
    """Every URL of every abstract with its context and score."""
    p = papers(spark, d, "abstract").filter(F.col("abstract").isNotNull())
    return p.select("id", F.posexplode(ux.scored_urls("abstract")).alias("pos", "s")).select("id", F.col("s.url").alias("url"), (F.col("pos") + 1).alias("pos"), F.col("s.score").alias("score"), F.col("s.context").alias("context"))


@query(
    f"""{_SCORED}, agg AS (SELECT id, string_agg(url, ' | ' ORDER BY pos) FILTER (score >= 0) AS good, string_agg(url, ' | ' ORDER BY pos) AS listed,
 arg_max(url, (score, -pos)) FILTER (score >= 0) AS best, arg_max(context, (score, -pos)) FILTER (score >= 0) AS ctx FROM scored GROUP BY id)
SELECT p.id, coalesce(good, listed, '') AS all_urls, coalesce(best, '') AS resource_url, best IS NOT NULL AS has_resource_url, coalesce(ctx, '') AS url_context
FROM papers p LEFT JOIN agg USING (id)"""
)
def resource_url(spark: SparkSession, d: str) -> DataFrame:
    """The resource URL of every paper: the first of the best scored."""
    p = papers(spark, d, "abstract").withColumn("s", ux.scored_urls("abstract"))
    return p.select("id", *[v.alias(k) for k, v in ux.resource_url(F.col("s")).items()])


_RECOVERED = rf"""{S.PAPERS}, r AS (SELECT id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all({_A}, {S.q('(?i)(' + ux._RECOVERY + ')')}, 1),
 lambda u: regexp_replace(u, '[.,;:!?)\]}}]+$', '')), lambda u: length(u) > 8))) AS urls FROM papers)"""


@query(f"WITH {_RECOVERED} SELECT id, array_to_string(urls, '|') AS urls FROM r")
def url_extract_recovery(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "abstract").select("id", F.array_join(ux.extract_urls_recovery("abstract"), "|").alias("urls"))


_N, _L = "lower(coalesce(primary_entity_short, ''))", "lower(coalesce(primary_entity_long, ''))"


@query(
    f"""WITH {_RECOVERED}, u AS (SELECT p.pmid, unnest(r.urls) AS url, coalesce(primary_entity_short, '') AS name, {_N} AS n,
 list_filter(regexp_split_to_array({_L}, '\\s+'), lambda w: length(w) > 4)[1:3] AS words FROM union_papers_with_primary_resources p JOIN r ON r.id = p.pmid),
x AS (SELECT pmid, url, {_recovery_sql()} AS reason, CASE WHEN length(n) > 2 AND contains(lower(url), n) THEN 'HIGH'
 WHEN len(list_filter(words, lambda w: contains(lower(url), w))) > 0 THEN 'HIGH'
 WHEN len(list_filter(regexp_extract_all(n, '[\\p{{L}}\\p{{N}}]'), lambda ch: contains(lower(url), ch))) > 0 THEN 'MEDIUM' ELSE 'LOW' END AS quality FROM u)
SELECT pmid, url, reason, quality, CAST(row_number() OVER (PARTITION BY pmid ORDER BY CASE quality WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END, url) AS INTEGER) AS place FROM x WHERE reason = ''"""
)
def url_recovery_ranked(spark: SparkSession, d: str) -> DataFrame:
    """The kept URLs of a paper's abstract, best match of its names first."""
    union = table(spark, d, "union_papers_with_primary_resources").select("pmid", "primary_entity_long", "primary_entity_short")
    found = papers(spark, d, "abstract").select(F.col("id").alias("pmid"), F.explode(ux.extract_urls_recovery("abstract")).alias("url"))
    j = found.join(union, "pmid")
    x = j.select("pmid", "url", ux.recovery_reason("url", "primary_entity_short").alias("reason"), ux.recovery_quality("url", "primary_entity_short", "primary_entity_long").alias("quality"))
    order = F.when(F.col("quality") == "HIGH", 0).when(F.col("quality") == "MEDIUM", 1).otherwise(2)
    return x.filter("reason = ''").withColumn("place", F.row_number().over(Window.partitionBy("pmid").orderBy(order, "url")))


_LIST = "coalesce(replace(all_urls, ' | ', '|'), '')"
_TAGGED = f"list_filter(list_transform(string_split({_LIST}, '|'), lambda u: trim(u)), lambda u: u <> '')"
_REASON = "CASE WHEN u = 'NOT_FOUND' THEN '' ELSE " + _cases("lower(u)", X.EXCLUSION_REASONS, "") + " END"


@query(
    f"""WITH {S.SCANS}, l AS (SELECT pmid, all_urls, {_TAGGED} AS r FROM scans),
k AS (SELECT pmid, all_urls, list_filter(r, lambda u: {_REASON} = '') AS kept, list_filter(list_transform(r, lambda u: {_REASON}), lambda x: x <> '') AS reasons FROM l)
SELECT pmid, CASE WHEN all_urls IS NULL OR {S.inlist('lower(trim(all_urls))', X.BLANKS)} OR len(kept) = 0 THEN 'NOT_FOUND' ELSE array_to_string(kept, '|') END AS urls,
 CASE WHEN all_urls IS NULL OR {S.inlist('lower(trim(all_urls))', X.BLANKS)} THEN '' ELSE array_to_string(reasons, '; ') END AS reasons FROM k"""
)
def filter_url_list(spark: SparkSession, d: str) -> DataFrame:
    """Packed URL lists without excluded URLs, with the reasons."""
    from resinv.plans.views import scans

    kept, reasons = ux.filter_url_list("all_urls")
    return scans(spark, d, "all_urls").select("pmid", kept.alias("urls"), F.array_join(reasons, "; ").alias("reasons"))


@query(
    f"""WITH {S.SCANS}, l AS (SELECT all_urls, {_TAGGED} AS r FROM scans WHERE all_urls IS NOT NULL AND NOT {S.inlist('lower(trim(all_urls))', X.BLANKS)}),
x AS (SELECT unnest(list_filter(list_transform(r, lambda u: {_REASON}), lambda x: x <> '')) AS reason FROM l) SELECT reason, count(*) AS n FROM x GROUP BY reason"""
)
def exclusion_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many URLs of the packed lists each reason excludes."""
    from resinv.plans.views import scans

    _, reasons = ux.filter_url_list("all_urls")
    return scans(spark, d, "all_urls").select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    f"""WITH u AS (SELECT record_num, extracted_url AS url, {S.host(S.with_scheme(_URL))} AS host FROM final_inventory
 WHERE extracted_url IS NOT NULL AND NOT {S.inlist('lower(trim(extracted_url))', X.BLANKS)} AND regexp_matches(extracted_url, '^[a-zA-Z]+://[^/]'))
SELECT record_num, url, first_value(url) OVER (PARTITION BY host ORDER BY record_num) AS canonical, count(*) OVER (PARTITION BY host) AS members FROM u"""
)
def url_clusters(spark: SparkSession, d: str) -> DataFrame:
    """URLs clustered by host; the first URL in record order is the canonical one."""
    rows = _inventory(spark, d).filter(~fx.is_blank("extracted_url") & F.col("extracted_url").rlike("^[a-zA-Z]+://[^/]"))
    return host_clusters(rows, "record_num", "extracted_url")


@query()
def url_clusters_cross_host(spark: SparkSession, d: str) -> DataFrame:
    """URLs clustered across the hosts of one registered name, by similarity of their parts."""
    rows = _inventory(spark, d).filter(~fx.is_blank("extracted_url") & F.col("extracted_url").rlike("^[a-zA-Z]+://[^/]"))
    return cross_host_clusters(rows, "extracted_url", 0.85)


# page content


_PAGE = "'<html><head><title>' || replace(coalesce(journal, ''), '&', '&amp;') || ' database</title>' || CASE WHEN doc_id % 3 = 0 THEN '<meta http-equiv=\"refresh\" content=\"0; url=/home/' || doc_id || '\">' ELSE '' END || '</head><body>' || coalesce(text, '') || '</body></html>'"


@query(
    rf"""WITH p AS (SELECT doc_id, {_PAGE} AS html FROM documents), t AS (SELECT doc_id, html, replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&amp;', '&') AS title,
 lower(substr(html, 1, {X.PAGE_CUT})) AS c FROM p),
s AS (SELECT doc_id, title, {" + ".join(f"CASE WHEN contains(lower(title), {S.q(w.lower())}) OR contains(c, {S.q(w.lower())}) THEN {n} ELSE 0 END" for w, n in X.PAGE_TERMS.items())} AS base,
 CASE WHEN {S.some('lower(title)', X.PAGE_TITLE_WORDS)} THEN {X.PAGE_TITLE_BONUS} ELSE 0 END AS bonus,
 concat_ws(', ', {", ".join(f"CASE WHEN contains(lower(title), {S.q(w.lower())}) OR contains(c, {S.q(w.lower())}) THEN {S.q(w)} END" for w in X.PAGE_TERMS)}) AS found,
 trim(regexp_extract(html, '(?is)<meta[^>]*http-equiv=["'']?refresh["'']?[^>]*url=["'']?([^"''>\s]+)', 1)) AS refresh FROM t)
SELECT doc_id, title, CAST(base AS INTEGER) AS base_score, CAST(bonus AS INTEGER) AS title_bonus, CAST(base + bonus AS INTEGER) AS total_score, found AS indicators_found, refresh,
 CASE WHEN base + bonus >= 15 THEN 'CRITICAL' WHEN base + bonus >= 10 THEN 'HIGH' WHEN base + bonus >= 5 THEN 'MEDIUM' WHEN base + bonus >= 1 THEN 'LOW' ELSE 'VERY LOW' END AS likelihood FROM s"""
)
def page_scan(spark: SparkSession, d: str) -> DataFrame:
    """Title, meta refresh, indicator terms and likelihood of pages made of the documents."""
    html = F.concat(
        F.lit("<html><head><title>"), F.replace(fx.filled("journal"), F.lit("&"), F.lit("&amp;")), F.lit(" database</title>"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('<meta http-equiv="refresh" content="0; url=/home/'), F.col("doc_id").cast("string"), F.lit('">'))).otherwise(""),
        F.lit("</head><body>"), fx.filled("text"), F.lit("</body></html>"),
    )
    p = table(spark, d, "documents").select("doc_id", html.alias("html")).withColumn("title", ux.page_title("html"))
    s = p.select("doc_id", "title", *[v.alias(k) for k, v in ux.page_scores("html", "title").items()], ux.meta_refresh("html").alias("refresh"))
    return s.withColumn("likelihood", ux.likelihood(F.col("total_score")))


@query(
    f"""WITH {S.SCANS} SELECT CASE WHEN url_scanner_score >= 15 THEN 'CRITICAL' WHEN url_scanner_score >= 10 THEN 'HIGH' WHEN url_scanner_score >= 5 THEN 'MEDIUM'
 WHEN url_scanner_score >= 1 THEN 'LOW' ELSE 'VERY LOW' END AS likelihood, count(*) AS n FROM scans GROUP BY 1"""
)
def likelihood_counts(spark: SparkSession, d: str) -> DataFrame:
    from resinv.plans.views import scans

    return scans(spark, d, "url_scanner_score").groupBy(ux.likelihood(F.col("url_scanner_score")).alias("likelihood")).agg(F.count("*").alias("n"))


@query()
def url_similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similar URLs of one registered name, with their similarity."""
    from resinv.operators.clusters import similar_urls

    rows = _inventory(spark, d).filter(~fx.is_blank("extracted_url") & F.col("extracted_url").rlike("^[a-zA-Z]+://[^/]"))
    return similar_urls(rows, "extracted_url", 0.5).select("a", "b", F.round("similarity", 6).alias("similarity"))
