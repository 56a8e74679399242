"""Queries that merge and match resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resinv.functions import fixed as X
from resinv.functions import names as nx
from resinv.functions import text as fx
from resinv.operators import matching as M
from resinv.operators import relational as R
from resinv.operators.merge import FIRST, merge_resources
from resinv.plans import sqltext as S
from resinv.plans.registry import query, table
from resinv.plans.views import scans

_UNION = [*[c for c in FIRST if c != "resource_url"], "pmid", "primary_score", "ner_confidence", "all_long", "all_short"]


def union_with_urls(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "union_papers_with_primary_resources").select(*_UNION)
    return u.join(scans(spark, d, "resource_url", "has_resource_url"), "pmid", "left")


def _with_urls_sql() -> str:
    return f"{S.SCANS}, w AS (SELECT u.*, s.resource_url, s.has_resource_url FROM union_papers_with_primary_resources u LEFT JOIN scans s USING (pmid))"


_NAME = "coalesce(nullif(trim(primary_entity_long), ''), nullif(trim(primary_entity_short), ''), '')"
_LOOSE = f"trim(regexp_replace(regexp_replace(lower(trim({_NAME})), '[_\\-.]', ' ', 'g'), '\\s+', ' ', 'g'))"
_TOKENS = lambda c: f"array_to_string(list_sort(list_distinct(list_filter(list_transform(flatten(list(string_split({c}, '|')) FILTER ({c} IS NOT NULL)), lambda t: trim(t)), lambda t: t NOT IN ('', 'nan')))), ' | ')"


def _merge_sql(source: str, name: str) -> str:
    firsts = ", ".join(f"arg_min({c}, pmid) FILTER ({c} IS NOT NULL) AS {c}" for c in FIRST)
    return f"""{name}_k AS (SELECT DISTINCT ON (host, norm_entity, pmid) * FROM (SELECT *, {S.host(S.with_scheme("coalesce(resource_url, '')"))} AS host, {_LOOSE} AS norm_entity FROM {source})),
{name} AS (SELECT host, norm_entity, string_agg(pmid, ', ' ORDER BY pmid) AS pmid, {firsts}, max(primary_score) AS primary_score, max(ner_confidence) AS ner_confidence,
 coalesce({_TOKENS('all_long')}, '') AS all_long, coalesce({_TOKENS('all_short')}, '') AS all_short, count(*) AS article_count FROM {name}_k GROUP BY host, norm_entity)"""


def _set(flag: str | None, profile: str) -> None:
    name = f"dedup_set_{ {'in_linguistic': 'a', 'in_setfit': 'b', None: 'c'}[flag] }_{profile}"
    keep = S.profile(profile, "title", "ling_score", "setfit_confidence", "has_resource_url")
    where = f"{flag} AND" if flag else "(in_linguistic OR in_setfit) AND"

    @query(f"WITH {_with_urls_sql()}, f AS (SELECT * FROM w WHERE {where} ({keep})), {_merge_sql('f', 'm')} SELECT * FROM m", name)
    def run(spark: SparkSession, d: str) -> DataFrame:
        w = union_with_urls(spark, d)
        passes = fx.passes_profile(profile, F.col("title"), F.col("ling_score"), F.col("setfit_confidence"), F.col("has_resource_url"))
        return merge_resources(w.filter((F.col(flag) if flag else (F.col("in_linguistic") | F.col("in_setfit"))) & passes))


for _profile in X.PROFILES:
    for _flag in ("in_linguistic", "in_setfit", None):
        _set(_flag, _profile)


@query(f"WITH {_with_urls_sql()}, {_merge_sql('w', 'm')} SELECT * FROM m")
def dedup_by_url_entity(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the resources of all papers of the union, merged by URL host and name."""
    return merge_resources(union_with_urls(spark, d))


@query(
    f"""WITH {_with_urls_sql()}, {_merge_sql('w', 'm')}
SELECT host, norm_entity, article_count, primary_score, row_number() OVER (ORDER BY article_count DESC, primary_score DESC NULLS LAST, host, norm_entity) AS position FROM m"""
)
def dedup_ranked(spark: SparkSession, d: str) -> DataFrame:
    """The merged resources with their position by number of papers, then score."""
    m = merge_resources(union_with_urls(spark, d)).select("host", "norm_entity", "article_count", "primary_score")
    return R.positions(m, [F.desc("article_count"), F.desc_nulls_last("primary_score"), "host", "norm_entity"])


# fuzzy matching of the union's short names to the inventory


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    w = union_with_urls(spark, d)
    a = M.sides(w, "primary_entity_short", "primary_entity_long", "resource_url", "pmid", "a")
    b = M.sides(table(spark, d, "final_inventory").select("best_name", "best_full", "extracted_url", "record_num"), "best_name", "best_full", "extracted_url", "record_num", "b")
    return a, b


def _sides_sql() -> str:
    def part(p: str, rows: str) -> str:
        host = f"regexp_replace({S.host('f')}, '^www\\.', '')"
        compound = f"(n >= 3 AND {S.inlist('q[n - 1]', X.COMPOUND_SUFFIXES_MATCH)})"
        base = f"CASE WHEN f = '' OR n < 2 THEN '' WHEN {compound} THEN q[n - 2] || '.' || q[n - 1] || '.' || q[n] ELSE q[n - 1] || '.' || q[n] END"
        return f"""{p}0 AS (SELECT *, lower(trim(name)) AS low FROM ({rows}) WHERE trim(coalesce(name, '')) <> ''),
{p}1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY low ORDER BY o, name) AS rn FROM {p}0) WHERE rn = 1),
{p}2 AS (SELECT *, {S.with_scheme("coalesce(url, '')")} AS f FROM {p}1), {p}3 AS (SELECT *, {host} AS h FROM {p}2),
{p}4 AS (SELECT *, string_split(h, '.') AS q, len(string_split(h, '.')) AS n FROM {p}3),
{p} AS (SELECT name AS {p}_name, low AS {p}_low, CASE WHEN f = '' OR n < 2 THEN '' WHEN {S.ends('h', X.PLATFORMS)} THEN h ELSE {base} END AS {p}_eff FROM {p}4)"""

    return f"""WITH {_with_urls_sql()}, {part('a', 'SELECT primary_entity_short AS name, resource_url AS url, pmid AS o FROM w')},
{part('b', 'SELECT best_name AS name, extracted_url AS url, record_num AS o FROM final_inventory')}"""


@query(f"{_sides_sql()} SELECT a_name, b_name FROM a JOIN b ON a_low = b_low")
def fuzzy_exact(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    return M.exact_matches(a, b).select("a_name", "b_name")


_KEY = lambda p: f"""SELECT {p}_low, 'p:' || {p}_low[1:2] AS k FROM {p} WHERE length({p}_low) >= 2
 UNION SELECT {p}_low, 'p:' || {p}_low[1:3] FROM {p} WHERE length({p}_low) >= 3
 UNION SELECT {p}_low, 'p:' || regexp_replace({p}_low, '\\d+', '', 'g')[1:2] FROM {p} WHERE length(regexp_replace({p}_low, '\\d+', '', 'g')) >= 2
 UNION SELECT {p}_low, 'd:' || {p}_eff FROM {p} WHERE {p}_eff <> ''"""  # noqa: E731


@query(
    f"""{_sides_sql()}, ka AS ({_KEY('a')}), kb AS ({_KEY('b')})
SELECT a_low, b_low FROM ka JOIN kb USING (k) WHERE a_low <> b_low
UNION SELECT a_low, b_low FROM a, b WHERE length(a_low) >= 4 AND length(b_low) >= 4 AND a_low <> b_low AND (contains(a_low, b_low) OR contains(b_low, a_low))"""
)
def fuzzy_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidate pairs of different names by block keys and containment."""
    a, b = _sides(spark, d)
    return M.candidates(a, b)


@query()
def fuzzy_best(spark: SparkSession, d: str) -> DataFrame:
    """The best candidate of each short name that has no exact match."""
    a, b = _sides(spark, d)
    rest = a.join(b, a["a_low"] == b["b_low"], "left_anti")
    scored = M.score_pairs(M.candidates(rest, b).join(rest, "a_low").join(b, "b_low"), M.LEAST)
    return M.best_candidates(scored).select("a_name", "b_name", "score", F.array_join("signals", ",").alias("signals"), "signal_count", "edit_distance", "confidence", "is_match", "review_flags")


@query()
def fuzzy_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    """All matches, each inventory name at most once, the losers named as conflicts."""
    a, b = _sides(spark, d)
    return M.fuzzy_match(a, b).select("a_name", "b_name", "score", "edit_distance", "confidence", "is_match", "winner", "review_flags")


@query()
def fuzzy_known_names(spark: SparkSession, d: str) -> DataFrame:
    """The short names that the inventory knows already."""
    a, b = _sides(spark, d)
    return M.fuzzy_match(a, b).filter("is_match = 'Y'").select("a_name").distinct()


def _ascii(x):
    """Other than ASCII characters as one question mark each."""
    return F.regexp_replace(x, r"[^\x00-\x7F]", "?")


_X, _Y = "lower(trim(coalesce(best_name, '')))", "lower(trim(coalesce(best_common, '')))"
_CUT = lambda v, s: f"CASE WHEN suffix({v}, '{s}') THEN {v}[1:length({v}) - {len(s)}] ELSE {v} END"
_INIT = "lower(array_to_string(list_transform(regexp_extract_all(l, '\\b[A-Za-z]\\w*'), lambda w: w[1]), ''))"


@query(
    f"""WITH p AS (SELECT record_num, {_X} AS x, {_Y} AS y FROM final_inventory WHERE {_X} <> '' AND {_Y} <> ''),
o AS (SELECT *, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS s, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS l FROM p)
SELECT record_num, CAST(levenshtein(regexp_replace(x, '[^\\x00-\\x7F]', '?', 'g'), regexp_replace(y, '[^\\x00-\\x7F]', '?', 'g')) AS INTEGER) AS edit_distance,
 x <> y AND regexp_replace(x, '\\d+', '', 'g') = regexp_replace(y, '\\d+', '', 'g') AND length(regexp_replace(x, '\\d+', '', 'g')) >= 2 AS digits_only,
 {" OR ".join(f"({_CUT('x', s)} = {_CUT('y', s)} AND length({_CUT('x', s)}) >= 2)" for s in ("db", "database", "base"))} AS suffix_only,
 CAST(CASE WHEN length(s) < 3 OR NOT contains(l, s) THEN 0.0 WHEN list_contains(regexp_extract_all(l, '\\b\\w+\\b'), s) THEN 0.8 WHEN CAST(length(s) AS DOUBLE) / length(l) >= 0.6 THEN 0.6
 WHEN length(s) >= 2 AND len(regexp_extract_all(l, '\\b[A-Za-z]\\w*')) >= 2 AND s = {_INIT} THEN 0.7 ELSE 0.3 END AS DOUBLE) AS containment FROM o"""
)
def name_comparison(spark: SparkSession, d: str) -> DataFrame:
    """How a record's two names differ: edit distance, digits, database suffix, containment."""
    f = table(spark, d, "final_inventory").select("record_num", fx.normal_entity("best_name").alias("x"), fx.normal_entity("best_common").alias("y")).filter("x <> '' and y <> ''")
    x, y = F.col("x"), F.col("y")
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    f = f.withColumn("s", short).withColumn("l", long)
    return f.select("record_num", F.levenshtein(_ascii(x), _ascii(y)).alias("edit_distance"), nx.digits_only_differ(x, y).alias("digits_only"), nx.database_suffix_differs(x, y).alias("suffix_only"), nx.containment(F.col("s"), F.col("l")).alias("containment"))
