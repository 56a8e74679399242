"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resinv.llm.canonical import map_to_list
from resinv.llm.leaks import leaked_windows, word_hashes
from resinv.llm.mixing import mix, token_counts
from resinv.llm.near import similar_sets, word_set
from resinv.llm.prose import quality
from resinv.llm.ranking import rank_aggregate
from resinv.llm.resources import is_name, occurrences, readable_date, url_host, with_group
from resinv.llm.survivors import Bundle, Dependency, best_bundles
from resinv.llm.variants import as_pairs, name_classes
from resinv.operators.components import components
from resinv.operators.lineage import cut
from resinv.operators.packed import split_packed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# 1. best representative of each duplicate group


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Per group of records and field, the record whose value survives.

    The three fields survive apart by rule: no dependency is stated, so no search is run.
    """
    date = readable_date(F.col("publication_date"))
    records = with_group(table(spark, d, "final_inventory"), table(spark, d, "union_papers_with_primary_resources"))
    bundles = [
        Bundle("best_name", ("best_name", "best_name_prob"), is_name(F.col("best_name")), (F.col("best_name_prob"),)),
        Bundle("extracted_url", ("extracted_url", "extracted_url_status"), url_host(F.col("extracted_url")) != "", (date,)),
        Bundle("publication_date", ("publication_date",), date.isNotNull(), (date,)),
    ]
    found = best_bundles(records, "group_num", "record_num", bundles)
    return found.select("group_num", F.col("bundle").alias("field"), F.col("record").alias("record_num"))


@query
def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    """One built record per group: name, URL, place and date bundles, the host fixing the country."""
    date = readable_date(F.col("publication_date"))
    records = cut(with_group(table(spark, d, "final_inventory"), table(spark, d, "union_papers_with_primary_resources")))
    host = F.nullif(url_host(F.col("extracted_url")), F.lit(""))
    country = F.nullif(F.trim("extracted_url_country"), F.lit(""))
    fields = {
        "name": ["best_name", "best_name_prob", "best_full"],
        "url": ["extracted_url", "extracted_url_status", "wayback_url"],
        "place": ["extracted_url_country", "extracted_url_coordinates"],
        "date": ["publication_date"],
    }
    bundles = [
        Bundle("name", tuple(fields["name"]), is_name(F.col("best_name")), (F.col("best_name_prob"),)),
        Bundle("url", tuple(fields["url"]), host.isNotNull(), (date,)),
        Bundle("place", tuple(fields["place"]), country.isNotNull(), (F.trim("extracted_url_coordinates") != "", date)),
        Bundle("date", tuple(fields["date"]), date.isNotNull(), (date,)),
    ]
    chosen = cut(best_bundles(records, "group_num", "record_num", bundles, [Dependency("url", host, "place", country)]))
    out = chosen.select("group_num").distinct()
    for b, names in fields.items():
        own = chosen.filter(F.col("bundle") == b).select("group_num", F.col("record").alias("record_num"))
        values = own.join(records.select("record_num", *names).dropDuplicates(["record_num"]), "record_num").select("group_num", *names)
        out = out.join(values, "group_num", "left")
    return out


# 3. variant spellings of names


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of different name strings that mean one resource."""
    inventory, union = table(spark, d, "final_inventory"), table(spark, d, "union_papers_with_primary_resources")
    classes = name_classes(occurrences(inventory, union))
    stored = inventory.select(F.col("best_name").alias("name")).unionByName(union.select(F.explode(F.array("primary_entity_long", "primary_entity_short")).alias("name"))).distinct()
    return as_pairs(cut(classes.join(stored.hint("merge"), "name", "left_semi")))


@query
def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct name with its class and the number of names in it."""
    inventory, union = table(spark, d, "final_inventory"), table(spark, d, "union_papers_with_primary_resources")
    classes = name_classes(occurrences(inventory, union))
    sizes = classes.groupBy("class").agg(F.count("*").alias("names"))
    return classes.hint("merge").join(sizes, "class").select("name", "class", "names")


# 6. mapping free-entered values to a reference list

_PACKED = {"affiliation_countries": "place", "grant_agencies": "organisation"}


def _mapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All values with their record and position, and ``(field, value, canon_id, score)`` of the distinct values that
    are not, letter for letter, an entry."""
    values = cut(split_packed(table(spark, d, "final_inventory"), "record_num", _PACKED))
    countries = table(spark, d, "country_list").select(F.lit("affiliation_countries").alias("field"), F.col("country_id").alias("id"), "name", F.col("alpha2").alias("code"), F.col("alpha3").alias("other"))
    agencies = table(spark, d, "agency_list").select(F.lit("grant_agencies").alias("field"), F.col("agency_id").alias("id"), "name", F.col("acronym").alias("code"), F.lit(None).cast("string").alias("other"))
    entries = countries.unionByName(agencies)
    typed = values.select("field", "value").distinct().join(entries.select("field", F.col("name").alias("value")), ["field", "value"], "left_anti")
    return values, map_to_list(typed, "value", entries, "id", "name", ["code", "other"], list_col="field")


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Each free-entered value that is no entry as it stands, with the entry meant, or 0."""
    values, mapped = _mapped(spark, d)
    return values.join(mapped, ["field", "value"]).select("record_num", "field", "pos", "canon_id").distinct()


@query
def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The values for which the lists have no entry, with how often they were typed."""
    values, mapped = _mapped(spark, d)
    times = values.groupBy("field", "value").agg(F.count("*").alias("times"))
    return times.join(mapped.filter("canon_id = 0"), ["field", "value"]).select("field", "value", "times", F.col("score").alias("best_score"))


# 5. near-duplicate records


def _paper_sets(spark: SparkSession, d: str) -> DataFrame:
    papers = table(spark, d, "papers_metadata")
    return papers.select("id", word_set(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))).alias("words"))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of ids whose word sets share more than 0.7 of their union."""
    links, members = similar_sets(_paper_sets(spark, d), "id", "words", (7, 10))
    members = cut(members)
    a, b = members.select(F.col("id").alias("x"), F.col("rep").alias("a")), members.select(F.col("id").alias("y"), F.col("rep").alias("b"))
    apart = links.select("a", "b").join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("x", "y")
    same = a.hint("merge").join(b, a["a"] == b["b"]).filter("x < y").select("x", "y")
    return apart.unionByName(same).filter("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


@query
def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per paper with near duplicates: its group and its number of direct links (similarity over 0.7)."""
    links, members = similar_sets(_paper_sets(spark, d), "id", "words", (7, 10))
    links, members = cut(links), cut(members)
    weight = members.groupBy("rep").agg(F.countDistinct("id").alias("ids"))
    groups = components(links)
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = ends.hint("merge").join(weight, ends["b"] == weight["rep"]).groupBy("a").agg(F.sum("ids").alias("apart"))
    per = weight.join(groups.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").join(degree.withColumnRenamed("a", "rep").hint("merge"), "rep", "left")
    per = per.filter("ids > 1 or component is not null").select("rep", F.coalesce("component", "rep").alias("component"), (F.col("ids") - 1 + F.coalesce("apart", F.lit(0))).alias("links"))
    rows = members.hint("merge").join(per, "rep").groupBy("id", "component").agg(F.max("links").alias("links"))
    names = rows.groupBy("component").agg(F.min("id").alias("group_id"))
    return rows.hint("merge").join(names, "component").select("id", "group_id", "links")


# 7. evaluation texts leaking into training text


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Items and documents whose text holds 12 or more consecutive words of the item."""
    found = leaked_windows(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text", window=12, max_edits=0)
    return found.select("item_id", "doc_id").distinct()


@query
def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Leaks with up to one edited word in a window of 12: how much of the item, and how close."""
    items = table(spark, d, "eval_items")
    found = leaked_windows(table(spark, d, "documents"), "doc_id", "text", items, "item_id", "text", window=12, max_edits=1)
    per = found.groupBy("item_id", "doc_id").agg(F.countDistinct("item_pos").alias("windows"), F.min("edits").alias("least_edits"))
    sizes = items.select(F.col("item_id").alias("i"), (F.size(word_hashes(F.col("text"))) - 11).alias("of_windows"))
    return per.join(sizes, per["item_id"] == sizes["i"]).select("item_id", "doc_id", "windows", "of_windows", "least_edits")


# 9. per-document text quality statistics


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are not natural prose."""
    return quality(table(spark, d, "documents")).filter(~F.col("prose")).select("doc_id").distinct()


@query
def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    """All statistics of every document, with percentiles and robust z-scores within its language."""
    return quality(table(spark, d, "documents"))


# 4. one ranking from several differently-scaled scores


@query
def p4_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The papers of the union by robust rank aggregation of their four scores."""
    union = table(spark, d, "union_papers_with_primary_resources").select("pmid", "ling_score", "setfit_confidence", "primary_score")
    # of several scans the latest counts, as everywhere
    scans = table(spark, d, "papers_with_scanner_scores").groupBy("pmid").agg(F.max(F.struct("scanned_at", "url_scanner_score"))["url_scanner_score"].alias("url_scanner_score"))
    papers = union.join(scans, "pmid", "left")
    return rank_aggregate(papers, "pmid", ["ling_score", "setfit_confidence", "primary_score", "url_scanner_score"])


def _rank_sql() -> str:
    ranks, branches = [], []
    for i, s in enumerate(("ling_score", "setfit_confidence", "primary_score", "url_scanner_score")):
        r = f"(rank() OVER (ORDER BY CAST({s} AS DOUBLE) DESC NULLS LAST) + (count(*) OVER (PARTITION BY CAST({s} AS DOUBLE)) - 1) / 2.0) / count({s}) OVER ()"
        ranks.append(f"CASE WHEN {s} IS NOT NULL THEN {r} END AS r{i}")
    for n in range(1, 5):
        looks = []
        for k in range(1, n + 1):
            terms = [f"{math.comb(n, j)} * pow(r[{k}], {j}) * pow(1 - r[{k}], {n - j})" for j in range(k, n + 1)]
            looks.append("(" + " + ".join(terms) + ")")
        branches.append(f"WHEN {n} THEN least(1.0, {n} * least({', '.join(looks)}))")
    return f"""
WITH scans AS (SELECT pmid, url_scanner_score FROM (SELECT pmid, url_scanner_score, row_number() OVER (PARTITION BY pmid ORDER BY scanned_at DESC NULLS LAST, url_scanner_score DESC NULLS LAST) AS rn
           FROM papers_with_scanner_scores) WHERE rn = 1),
papers AS (SELECT u.pmid, ling_score, setfit_confidence, primary_score, url_scanner_score
           FROM union_papers_with_primary_resources u LEFT JOIN scans USING (pmid)),
ranks AS (SELECT pmid, {", ".join(ranks)} FROM papers),
lists AS (SELECT pmid, list_sort(list_filter([r0, r1, r2, r3], lambda x: x IS NOT NULL)) AS r FROM ranks),
rhos AS (SELECT pmid, CAST(len(r) AS INTEGER) AS scored,
                CAST(printf('%.9e', CAST(CASE len(r) {" ".join(branches)} ELSE 1.0 END AS DOUBLE)) AS DOUBLE) AS rho FROM lists)
SELECT pmid, scored, rho, rank() OVER (ORDER BY rho) AS rank FROM rhos"""


SQL["p4_ranking"] = _rank_sql()


# 8. mixing sources to target weights


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    counted = cut(token_counts(table(spark, d, "documents").select("doc_id", "source", "text"), "text"))
    return mix(counted, "doc_id", "source", "tokens", table(spark, d, "mix_targets"))


@query
def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mixture, with their shard and how many times they are used in it."""
    return _mixed(spark, d)[0].withColumnRenamed("id", "doc_id")


@query
def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Per source the wanted and the actual share of all tokens, the stock, the tokens used and the repeats."""
    return _mixed(spark, d)[1]


# SQL twins of the exact searches

_W = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
SQL["p5_found"] = f"""
WITH s AS (SELECT DISTINCT id, list_sort(list_distinct({_W.format("coalesce(title, '') || ' ' || coalesce(abstract, '')")})) AS w
           FROM papers_metadata WHERE trim(coalesce(id, '')) <> ''),
p AS (SELECT a.id AS id_a, b.id AS id_b, len(list_intersect(a.w, b.w)) AS i, len(a.w) + len(b.w) AS n FROM s a JOIN s b ON a.id < b.id)
SELECT DISTINCT id_a, id_b FROM p WHERE 10 * i > 7 * (n - i)"""
SQL["p5_groups"] = f"""
WITH RECURSIVE s AS (SELECT DISTINCT id, list_sort(list_distinct({_W.format("coalesce(title, '') || ' ' || coalesce(abstract, '')")})) AS w
                     FROM papers_metadata WHERE trim(coalesce(id, '')) <> ''),
t AS (SELECT id, w, len(w) AS n FROM s WHERE len(w) > 0),
p AS (SELECT a.id AS x, a.w AS wx, b.id AS y FROM t a JOIN t b ON (a.id <> b.id OR a.w <> b.w) AND 10 * least(a.n, b.n) >= 7 * greatest(a.n, b.n)
      WHERE 10 * len(list_intersect(a.w, b.w)) > 7 * (a.n + b.n - len(list_intersect(a.w, b.w)))),
e AS (SELECT DISTINCT x, y FROM p WHERE x <> y),
r AS (SELECT DISTINCT x AS id, x AS root FROM e UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.id),
g AS (SELECT id, min(root) AS group_id FROM r GROUP BY id),
l AS (SELECT x AS id, max(n) AS links FROM (SELECT x, wx, count(*) AS n FROM p GROUP BY x, wx) GROUP BY x)
SELECT l.id, coalesce(group_id, l.id) AS group_id, links FROM l LEFT JOIN g USING (id)"""
SQL["p7_found"] = f"""
WITH d0 AS (SELECT doc_id, {_W.format("coalesce(text, '')")} AS w FROM documents), i0 AS (SELECT item_id, {_W.format("coalesce(text, '')")} AS w FROM eval_items),
d1 AS (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS p FROM d0), i1 AS (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS p FROM i0),
d2 AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 11], ' ') AS g FROM d1), i2 AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 11], ' ') AS g FROM i1)
SELECT DISTINCT item_id, doc_id FROM d2 JOIN i2 USING (g)"""
