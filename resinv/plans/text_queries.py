"""Queries on the text of papers: scores, tiers, filters, titles, quality flags, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resinv.functions import fixed as X
from resinv.functions import text as fx
from resinv.plans import sqltext as S
from resinv.plans.registry import query, table
from resinv.plans.views import papers, scans

_T, _A = "coalesce(title, '')", "coalesce(abstract, '')"
_TEXT = f"lower({_T} || ' ' || {_A})"
_BUILD, _USAGE = S.counted("txt", X.IMPLEMENTATION_KEYWORDS), S.counted("txt", X.USAGE_KEYWORDS)
_SCORED = f"""WITH {S.PAPERS}, p AS (SELECT id, {_T} AS t, {_A} AS a, {_TEXT} AS txt FROM papers),
hits AS (SELECT id, {S.matched('txt', X.INTRODUCTION_PATTERNS)} AS i, {S.matched('lower(t)', X.TITLE_PATTERNS)} AS n,
  regexp_matches(a, {S.q('(?i)' + X.URL_PATTERN)}) AS u, {_BUILD} AS b, {_USAGE} AS g FROM p),
scored AS (SELECT id, CAST(CASE WHEN i THEN 2 ELSE 0 END + CASE WHEN n THEN 1 ELSE 0 END + CASE WHEN u THEN 1 ELSE 0 END
  + least(b * 0.5, 2) - least(g * 0.5, 2) AS DOUBLE) AS ling_score,
  coalesce(nullif(concat_ws('; ', CASE WHEN i THEN 'intro_pattern' END, CASE WHEN n THEN 'title_pattern' END, CASE WHEN u THEN 'has_url' END,
    CASE WHEN b > 0 THEN 'impl_kw=' || b END, CASE WHEN g > 0 THEN 'usage_kw=' || g END), ''), 'none') AS ling_evidence,
  i AS ling_has_intro_pattern, n AS ling_has_title_pattern, u AS ling_has_url, CAST(b AS INTEGER) AS ling_impl_keywords,
  CAST(g AS INTEGER) AS ling_usage_keywords FROM hits),
tiers AS (SELECT id, ling_score, CASE WHEN ling_score >= 2 THEN 'high' WHEN ling_score < -1 THEN 'low' ELSE 'medium' END AS tier FROM scored)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    p = papers(spark, d, "title", "abstract")
    return p.select("id", *[v.alias(k) for k, v in fx.linguistic_score("title", "abstract").items()])


@query(f"{_SCORED} SELECT * FROM scored")
def ling_score(spark: SparkSession, d: str) -> DataFrame:
    """Rule-based score of every paper, with its parts."""
    return _scored(spark, d)


@query(f"{_SCORED} SELECT * FROM tiers")
def ling_tiers(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("id", "ling_score", fx.score_tier(F.col("ling_score")).alias("tier"))


@query(f"{_SCORED} SELECT tier, count(*) AS papers, avg(ling_score) AS mean_score FROM tiers GROUP BY tier")
def ling_tier_counts(spark: SparkSession, d: str) -> DataFrame:
    return ling_tiers(spark, d).groupBy("tier").agg(F.count("*").alias("papers"), F.avg("ling_score").alias("mean_score"))


_SEMI = f"""{_SCORED}, wanted AS (SELECT DISTINCT regexp_replace(trim(publication_id), '\\.0+$', '') AS id FROM ner_union
 WHERE regexp_matches(regexp_replace(trim(publication_id), '\\.0+$', ''), '^\\d+$'))"""


@query(f"{_SEMI} SELECT s.* FROM scored s WHERE s.id IN (SELECT id FROM wanted)")
def ling_score_of_named(spark: SparkSession, d: str) -> DataFrame:
    """The score of the papers that name an entity."""
    wanted = table(spark, d, "ner_union").select(fx.clean_id("publication_id").alias("id")).filter("id is not null").distinct()
    return _scored(spark, d).join(wanted, "id", "left_semi")


@query(
    f"""WITH {S.PAPERS} SELECT id, CAST({S.modifier('title')} AS INTEGER) AS modifier, CASE WHEN lower({_T}) = '' THEN 'no_title'
 WHEN {S.some(f'lower({_T})', X.DATA_RESOURCE_WORDS)} THEN 'data_resource_boost'
 WHEN {S.matched(f'lower({_T})', X.METHODOLOGY_PATTERNS, False)} THEN 'methodology_penalty' ELSE 'neutral' END AS reason FROM papers"""
)
def title_modifier(spark: SparkSession, d: str) -> DataFrame:
    value, reason = fx.title_modifier("title")
    return papers(spark, d, "title").select("id", value.alias("modifier"), reason.alias("reason"))


@query(
    f"""WITH {S.PAPERS} SELECT id, """
    + ", ".join(f"{S.some(f'lower({_T})', p['keywords'])} AS {n}" for n, p in X.PROFILES.items())
    + " FROM papers"
)
def keyword_match(spark: SparkSession, d: str) -> DataFrame:
    """Whether a title has a keyword of each profile."""
    t = F.lower(fx.filled("title"))
    return papers(spark, d, "title").select("id", *[fx.contains_any(t, p["keywords"]).alias(n) for n, p in X.PROFILES.items()])


def _profile(name: str):
    sql = f"""WITH {S.SCANS}, j AS (SELECT u.pmid, u.title, u.ling_score, u.setfit_confidence, s.has_resource_url
 FROM union_papers_with_primary_resources u LEFT JOIN scans s USING (pmid))
 SELECT pmid, {S.profile(name, 'title', 'ling_score', 'setfit_confidence', 'has_resource_url')} AS passes FROM j"""

    @query(sql, f"profile_filter_{name}")
    def run(spark: SparkSession, d: str) -> DataFrame:
        union = table(spark, d, "union_papers_with_primary_resources").select("pmid", "title", "ling_score", "setfit_confidence")
        joined = union.join(scans(spark, d, "has_resource_url"), "pmid", "left")
        passes = fx.passes_profile(name, F.col("title"), F.col("ling_score"), F.col("setfit_confidence"), F.col("has_resource_url"))
        return joined.select("pmid", passes.alias("passes"))


for _name in X.PROFILES:
    _profile(_name)


_ENTITY = r"""CASE WHEN contains(t, ':') THEN trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(e3, '(?i)\bv?\d+\.?\d*\b', '', 'g'),
 '(?i)\bversion\s+\d+\.?\d*\b', '', 'g'), '\s*\([^)]+\)\s*$', ''), '\s+', ' ', 'g')) ELSE '' END"""
_TITLE_CTES = f"""{S.PAPERS}, t0 AS (SELECT id, {_T} AS t, trim(split_part({_T}, ':', 1)) AS e0 FROM papers),
t1 AS (SELECT *, CASE WHEN starts_with(e0, 'The ') THEN trim(substr(e0, 5)) ELSE e0 END AS e1 FROM t0),
t2 AS (SELECT *, CASE WHEN starts_with(e1, 'A ') THEN trim(substr(e1, 3)) ELSE e1 END AS e2 FROM t1),
t3 AS (SELECT *, CASE WHEN starts_with(e2, 'An ') THEN trim(substr(e2, 4)) ELSE e2 END AS e3 FROM t2),
entities AS (SELECT id, t, {_ENTITY} AS entity_from_title FROM t3)"""


@query(f"WITH {_TITLE_CTES} SELECT id, entity_from_title FROM entities")
def title_entity(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "title").select("id", fx.title_entity("title").alias("entity_from_title"))


@query(f"WITH {S.PAPERS} SELECT id, {S.some(f'lower({_T})', X.DB_KEYWORDS)} AS db_keyword_found, CAST({S.weighed(f'lower({_T})', X.DB_WEIGHTS)} AS INTEGER) AS db_keyword_score FROM papers")
def db_keyword_score(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "title").select("id", fx.has_db_keyword("title").alias("db_keyword_found"), fx.db_keyword_score("title").alias("db_keyword_score"))


_QUALITY = f"""WITH {_TITLE_CTES}, j AS (SELECT u.pmid, e.t, e.entity_from_title, u.primary_entity_long AS l, u.primary_entity_short AS s
 FROM union_papers_with_primary_resources u JOIN entities e ON u.pmid = e.id),
k AS (SELECT pmid, {S.some('lower(t)', X.DB_KEYWORDS)} AS db_keyword_found, CAST({S.weighed('lower(t)', X.DB_WEIGHTS)} AS INTEGER) AS db_keyword_score,
 entity_from_title <> '' AND lower(trim(entity_from_title)) IN (lower(trim(coalesce(l, ''))), lower(trim(coalesce(s, '')))) AS title_entity_in_ner FROM j),
flags AS (SELECT *, db_keyword_found AND title_entity_in_ner AS very_high_conf FROM k)"""


def _flags(spark: SparkSession, d: str) -> DataFrame:
    union = table(spark, d, "union_papers_with_primary_resources").select("pmid", "primary_entity_long", "primary_entity_short")
    j = union.join(papers(spark, d, "title").withColumnRenamed("id", "pmid"), "pmid").withColumn("e", fx.title_entity("title"))
    e = F.lower(F.trim("e"))
    match = (F.col("e") != "") & ((e == fx.normal_entity("primary_entity_long")) | (e == fx.normal_entity("primary_entity_short")))
    k = j.select("pmid", fx.has_db_keyword("title").alias("db_keyword_found"), fx.db_keyword_score("title").alias("db_keyword_score"), match.alias("title_entity_in_ner"))
    return k.withColumn("very_high_conf", F.col("db_keyword_found") & F.col("title_entity_in_ner"))


@query(f"{_QUALITY} SELECT * FROM flags")
def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    """Whether the title has a database word and names the paper's own resource."""
    return _flags(spark, d)


@query(
    f"""{_QUALITY} SELECT count(*) AS papers, count(*) FILTER (db_keyword_found) AS with_keyword, count(*) FILTER (title_entity_in_ner) AS title_matches,
 count(*) FILTER (very_high_conf) AS very_high, avg(db_keyword_score) AS mean_score, median(db_keyword_score) AS median_score,
 min(db_keyword_score) AS min_score, max(db_keyword_score) AS max_score FROM flags"""
)
def quality_stats(spark: SparkSession, d: str) -> DataFrame:
    f = _flags(spark, d)
    return f.agg(
        F.count("*").alias("papers"), F.count_if("db_keyword_found").alias("with_keyword"), F.count_if("title_entity_in_ner").alias("title_matches"),
        F.count_if("very_high_conf").alias("very_high"), F.avg("db_keyword_score").alias("mean_score"), F.percentile("db_keyword_score", 0.5).alias("median_score"),
        F.min("db_keyword_score").alias("min_score"), F.max("db_keyword_score").alias("max_score"),
    )


_STRIPPED = r"regexp_replace(regexp_replace(abstract, '([\w.?!])</?h\d>(\w)', '\1 \2', 'g'), '<[\w/]+>', '', 'g')"


@query(f"WITH {S.PAPERS} SELECT id, {_STRIPPED} AS abstract FROM papers")
def strip_xml(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "abstract").select("id", fx.strip_xml("abstract").alias("abstract"))


_PERIOD = f"CASE WHEN {_T} = '' THEN '' WHEN regexp_matches({_T}, '[.?!]$') THEN {_T} ELSE {_T} || '.' END"


@query(f"WITH {S.PAPERS} SELECT id, {_PERIOD} || ' ' || {_A} AS title_abstract FROM papers")
def title_abstract(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "title", "abstract").select("id", fx.title_abstract("title", "abstract").alias("title_abstract"))


@query(f"WITH {S.PAPERS} SELECT id, CASE WHEN {_T} <> '' AND {_A} <> '' THEN {_T} || chr(10) || chr(10) || {_A} WHEN {_T} <> '' THEN {_T} ELSE {_A} END AS text FROM papers")
def classifier_text(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "title", "abstract").select("id", fx.classifier_text("title", "abstract").alias("text"))


@query(r"SELECT doc_id, substr(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 1, 100000) AS text, length(text) AS full_length FROM documents")
def fulltext_plain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", fx.plain_fulltext("text").alias("text"), F.length("text").cast("long").alias("full_length"))


@query(f"WITH {S.PAPERS} SELECT id, replace(abstract, chr(10), '') AS abstract FROM papers")
def strip_newlines(spark: SparkSession, d: str) -> DataFrame:
    return papers(spark, d, "abstract").select("id", fx.strip_newlines("abstract").alias("abstract"))


_BINARY = ["inEPMC", "inPMC", "hasDbCrossReferences", "hasData", "hasSuppl", "isOpenAccess"]
_INT = lambda x: f"CASE WHEN trim(coalesce({x}, '')) IN ('Y', 'True', 'true') THEN 1 WHEN trim(coalesce({x}, '')) IN ('', 'N', 'False', 'false') THEN 0 ELSE coalesce(TRY_CAST(CASE WHEN regexp_matches(trim({x}), '^[+-]?\\d+$') THEN trim({x}) END AS INTEGER), 0) END"
_JSON = lambda x: f"CASE WHEN starts_with(trim({x}), '[') AND json_valid({x}) THEN list_filter(CAST({x} AS VARCHAR[]), lambda e: e IS NOT NULL) ELSE [] END"


def features(df: DataFrame) -> DataFrame:
    """Metadata features of papers; a paper without year counts as of the missing year."""
    year, cited = F.coalesce("pubYear", F.lit(X.MISSING_YEAR)), F.coalesce("citedByCount", F.lit(0))
    flags = {b: fx.flag_to_int(b) for b in _BINARY}
    terms, kinds, words = fx.json_list("meshTerms"), fx.json_list("pubType"), F.transform(fx.json_list("keywords"), F.lower)
    age = F.least(F.greatest(X.REFERENCE_YEAR - year, F.lit(0)), F.lit(100))
    return df.select(
        "id", cited.alias("cited"), *[v.alias(f"is_{k}") for k, v in flags.items()],
        F.log1p(F.greatest(cited, F.lit(0)).cast("double")).alias("log_citations"), age.alias("years_since_pub"),
        F.least(cited / (age + 1), F.lit(10000.0)).alias("citation_age_ratio"), (cited == 0).cast("int").alias("is_uncited"),
        fx.total([flags[b] for b in _BINARY[2:]]).alias("access_score"), (year >= 2018).cast("int").alias("is_recent"), (year < 2010).cast("int").alias("is_old"),
        F.size(terms).alias("mesh_terms"), F.size(kinds).alias("pub_types"), F.array_contains(kinds, "Review").cast("int").alias("is_review"),
        F.array_contains(kinds, "Letter").cast("int").alias("is_letter"), F.length(fx.filled("title")).alias("title_length"),
        F.length(fx.filled("abstract")).alias("abstract_length"), (F.length(fx.filled("abstract")) > 0).cast("int").alias("has_abstract"),
        F.size(words).alias("keyword_count"), F.exists(words, lambda w: w.isin(*X.KEYWORD_TERMS)).cast("int").alias("has_database_keyword"),
    )


@query(
    f"""WITH {S.PAPERS}, f AS (SELECT id, title, abstract, coalesce(citedByCount, 0) AS cited, coalesce(pubYear, 2023) AS y, {", ".join(f"{_INT(b)} AS {b}" for b in _BINARY)},
 {_JSON('meshTerms')} AS m, {_JSON('pubType')} AS k, {_JSON('keywords')} AS w FROM papers),
g AS (SELECT *, least(greatest(2025 - y, 0), 100) AS age FROM f)
SELECT id, cited, {", ".join(f"{b} AS is_{b}" for b in _BINARY)}, ln(1 + greatest(cited, 0)) AS log_citations, age AS years_since_pub,
 least(CAST(cited AS DOUBLE) / (age + 1), 10000.0) AS citation_age_ratio, CAST(cited = 0 AS INTEGER) AS is_uncited,
 hasDbCrossReferences + hasData + hasSuppl + isOpenAccess AS access_score, CAST(y >= 2018 AS INTEGER) AS is_recent, CAST(y < 2010 AS INTEGER) AS is_old,
 CAST(len(m) AS INTEGER) AS mesh_terms, CAST(len(k) AS INTEGER) AS pub_types, CAST(list_contains(k, 'Review') AS INTEGER) AS is_review,
 CAST(list_contains(k, 'Letter') AS INTEGER) AS is_letter, CAST(length({_T}) AS INTEGER) AS title_length, CAST(length({_A}) AS INTEGER) AS abstract_length,
 CAST(length({_A}) > 0 AS INTEGER) AS has_abstract, CAST(len(w) AS INTEGER) AS keyword_count,
 CAST(len(list_filter(w, lambda e: {S.inlist('lower(e)', X.KEYWORD_TERMS)})) > 0 AS INTEGER) AS has_database_keyword FROM g"""
)
def tabular_features(spark: SparkSession, d: str) -> DataFrame:
    return features(papers(spark, d, "title", "abstract", "citedByCount", "pubYear", "meshTerms", "pubType", "keywords", *_BINARY))


@query(
    f"""WITH {S.PAPERS}, x AS (SELECT quantile_cont(CAST(coalesce(citedByCount, 0) AS DOUBLE), 0.75) AS bound FROM papers)
SELECT id, coalesce(citedByCount, 0) AS cited, bound, coalesce(citedByCount, 0) > bound AS is_highly_cited FROM papers, x"""
)
def high_cited_quantile(spark: SparkSession, d: str) -> DataFrame:
    """Papers cited more than the upper quartile of all papers."""
    p = papers(spark, d, "citedByCount").select("id", F.coalesce("citedByCount", F.lit(0)).alias("cited"))
    bound = p.agg(F.percentile("cited", 0.75)).scalar()
    return p.withColumn("bound", bound).withColumn("is_highly_cited", F.col("cited") > F.col("bound"))


@query(
    f"""WITH {S.PAPERS}, m AS (SELECT id, unnest({_JSON('meshTerms')}) AS term FROM papers)
SELECT term, count(*) AS papers FROM m GROUP BY term"""
)
def mesh_term_counts(spark: SparkSession, d: str) -> DataFrame:
    """JSON arrays in a cell, parsed, exploded and counted."""
    return papers(spark, d, "meshTerms").select(F.explode(fx.json_list("meshTerms")).alias("term")).groupBy("term").agg(F.count("*").alias("papers"))
