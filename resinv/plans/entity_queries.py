"""Queries on named entities: union, counters, the primary entity of a paper, inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resinv.functions import text as fx
from resinv.operators.relational import keep_first, min_count
from resinv.plans import sqltext as S
from resinv.plans.registry import query, table
from resinv.plans.views import papers

# the union keeps, of each (paper, text, type), the row of the first system, then the surest
_UNION = r"""clean AS (SELECT CASE WHEN regexp_matches(regexp_replace(trim(publication_id), '\.0+$', ''), '^\d+$') THEN regexp_replace(trim(publication_id), '\.0+$', '') END AS pmid,
 entity_text, entity_type, confidence, source FROM ner_union WHERE trim(coalesce(entity_text, '')) <> ''),
merged AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pmid, entity_text, entity_type
 ORDER BY CASE source WHEN 'spacy' THEN 0 ELSE 1 END, confidence DESC NULLS LAST) AS rn FROM clean WHERE pmid IS NOT NULL) WHERE rn = 1)"""


def merged(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ner_union").select(fx.clean_id("publication_id").alias("pmid"), "entity_text", "entity_type", "confidence", "source")
    rows = rows.filter("pmid is not null and trim(coalesce(entity_text, '')) <> ''")
    return keep_first(rows, ["pmid", "entity_text", "entity_type"], [F.when(F.col("source") == "spacy", 0).otherwise(1), F.desc_nulls_last("confidence")])


@query(f"WITH {_UNION} SELECT * FROM merged")
def ner_union(spark: SparkSession, d: str) -> DataFrame:
    """Entities of both systems, one row per paper, text and type."""
    return merged(spark, d)


@query(f"WITH {_UNION} SELECT * FROM clean WHERE pmid IS NOT NULL AND length(trim(entity_text)) > 1 AND NOT contains(entity_text, 'http') AND length(trim(entity_text)) <= 100")
def entity_filter(spark: SparkSession, d: str) -> DataFrame:
    """Entities that are no single letter, no URL and not too long."""
    rows = table(spark, d, "ner_union").select(fx.clean_id("publication_id").alias("pmid"), "entity_text", "entity_type", "confidence", "source")
    n = F.length(F.trim("entity_text"))
    return rows.filter(F.col("pmid").isNotNull() & (n > 1) & ~F.col("entity_text").contains("http") & (n <= 100))


_COUNTERS = f"""{_UNION}, rows AS (SELECT pmid, lower(trim(entity_text)) AS entity, entity_text, source, confidence, CASE source WHEN 'spacy' THEN 0 ELSE 1 END AS o FROM merged),
counters AS (SELECT pmid, entity, count(*) FILTER (source = 'spacy') AS spacy_count, count(*) FILTER (source = 'v2') AS v2_count, count(*) AS total_mentions,
 coalesce(max(confidence) FILTER (source = 'v2'), 0.0) AS v2_max_prob, arg_max((entity_text = upper(entity_text) AND entity_text <> lower(entity_text)) OR length(entity_text) <= 6, (o, entity_text)) AS is_short
 FROM rows GROUP BY pmid, entity)"""


def counters(spark: SparkSession, d: str) -> DataFrame:
    """Per paper and entity: mentions by system, the surest, and whether the last spelling seen is a short form."""
    rows = merged(spark, d).withColumn("entity", fx.normal_entity("entity_text"))
    last = F.max(F.struct(F.when(F.col("source") == "spacy", 0).otherwise(1).alias("o"), "entity_text", fx.is_short_form("entity_text").alias("s")))["s"]
    return rows.groupBy("pmid", "entity").agg(
        F.count_if(F.col("source") == "spacy").alias("spacy_count"), F.count_if(F.col("source") == "v2").alias("v2_count"), F.count("*").alias("total_mentions"),
        F.coalesce(F.max(F.when(F.col("source") == "v2", F.col("confidence"))), F.lit(0.0)).alias("v2_max_prob"), last.alias("is_short"),
    )


@query(f"WITH {_COUNTERS} SELECT * FROM counters")
def entity_counters(spark: SparkSession, d: str) -> DataFrame:
    return counters(spark, d)


_SCORED = f"""{S.PAPERS}, {_COUNTERS}, scored AS (SELECT c.*, CASE WHEN contains(lower(trim(coalesce(p.title, ''))), c.entity) THEN 10.0 ELSE 0 END
 + CASE WHEN contains(lower(trim(coalesce(p.abstract, ''))), c.entity) THEN 5.0 ELSE 0 END + CASE WHEN spacy_count > 0 AND v2_count > 0 THEN 3.0 ELSE 0 END
 + v2_max_prob + total_mentions AS score FROM counters c LEFT JOIN papers p ON p.id = c.pmid)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    p = papers(spark, d, "title", "abstract").withColumnRenamed("id", "pmid")
    j = counters(spark, d).join(p, "pmid", "left")
    score = (
        F.contains(fx.normal_entity("title"), F.col("entity")).cast("int") * 10.0
        + F.contains(fx.normal_entity("abstract"), F.col("entity")).cast("int") * 5.0
        + ((F.col("spacy_count") > 0) & (F.col("v2_count") > 0)).cast("int") * 3.0
        + F.col("v2_max_prob")
        + F.col("total_mentions")
    )
    return j.withColumn("score", score).drop("title", "abstract")


@query(f"WITH {_SCORED} SELECT * FROM scored")
def entity_scores(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d)


@query(
    f"""WITH {_SCORED}, m AS (SELECT *, max(score) OVER (PARTITION BY pmid) AS top FROM scored),
r AS (SELECT pmid, string_agg(entity, ' | ' ORDER BY entity) FILTER (score = top AND NOT is_short) AS primary_entity_long,
 string_agg(entity, ' | ' ORDER BY entity) FILTER (score = top AND is_short) AS primary_entity_short, max(top) AS primary_score,
 CASE WHEN count(*) FILTER (score = top) > 1 THEN 'conflict' WHEN max(top) < 5 THEN 'low_score' ELSE 'ok' END AS status,
 string_agg(entity, ' | ' ORDER BY entity) FILTER (score < top AND NOT is_short) AS all_long, string_agg(entity, ' | ' ORDER BY entity) FILTER (score < top AND is_short) AS all_short,
 arg_min(concat_ws('+', CASE WHEN spacy_count > 0 THEN 'spacy' END, CASE WHEN v2_count > 0 THEN 'v2' END), entity) FILTER (score = top) AS ner_source,
 arg_min(v2_max_prob, entity) FILTER (score = top) AS ner_confidence FROM m GROUP BY pmid)
SELECT u.pmid, coalesce(primary_entity_long, '') AS primary_entity_long, coalesce(primary_entity_short, '') AS primary_entity_short, coalesce(r.primary_score, 0.0) AS primary_score,
 coalesce(r.status, 'no_entities') AS status, coalesce(r.all_long, '') AS all_long, coalesce(r.all_short, '') AS all_short, coalesce(r.ner_source, '') AS ner_source, r.ner_confidence
FROM (SELECT pmid FROM union_papers_with_primary_resources) u LEFT JOIN r USING (pmid)"""
)
def primary_entity(spark: SparkSession, d: str) -> DataFrame:
    """The best-scored entities of each paper of the union, ties kept as a conflict, the others listed."""
    m = scored(spark, d).withColumn("top", F.max("score").over(Window.partitionBy("pmid")))
    best, short = F.col("score") == F.col("top"), F.col("is_short")
    listed = lambda cond: F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("entity")))), " | ")
    source = F.concat_ws("+", F.when(F.col("spacy_count") > 0, "spacy"), F.when(F.col("v2_count") > 0, "v2"))
    lead = F.min(F.when(best, F.struct("entity", source.alias("src"), F.col("v2_max_prob").alias("prob"))))
    r = m.groupBy("pmid").agg(
        listed(best & ~short).alias("primary_entity_long"), listed(best & short).alias("primary_entity_short"), F.max("top").alias("primary_score"),
        F.when(F.count_if(best) > 1, "conflict").when(F.max("top") < 5, "low_score").otherwise("ok").alias("status"),
        listed(~best & ~short).alias("all_long"), listed(~best & short).alias("all_short"), lead["src"].alias("ner_source"), lead["prob"].alias("ner_confidence"),
    )
    union = table(spark, d, "union_papers_with_primary_resources").select("pmid")
    blanks = {c: "" for c in ("primary_entity_long", "primary_entity_short", "all_long", "all_short", "ner_source")}
    return union.join(r, "pmid", "left").na.fill({**blanks, "primary_score": 0.0, "status": "no_entities"})


@query(
    f"""WITH {_COUNTERS}, shorts AS (SELECT pmid, entity AS short FROM counters WHERE length(entity) <= 6),
longs AS (SELECT pmid, entity AS long, array_to_string(list_transform(list_filter(regexp_split_to_array(entity, '\\s+'), lambda w: w <> ''), lambda w: w[1]), '') AS initials FROM counters WHERE length(entity) > 6)
SELECT pmid, short, long FROM shorts JOIN longs USING (pmid) WHERE short = initials"""
)
def acronym_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Short and long forms of one paper of which the one is the initials of the other: an equi-join, no pair is compared."""
    e = counters(spark, d).select("pmid", "entity")
    words = F.filter(F.split("entity", r"\s+"), lambda w: w != "")
    initials = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    longs = e.filter(F.length("entity") > 6).select("pmid", F.col("entity").alias("long"), initials.alias("short"))
    return e.filter(F.length("entity") <= 6).withColumnRenamed("entity", "short").join(longs, ["pmid", "short"])


_MENTIONS = f"""{_UNION}, m0 AS (SELECT pmid, entity_text AS mention, entity_type AS label, confidence AS prob FROM clean WHERE pmid IS NOT NULL AND source = 'v2'),
m1 AS (SELECT pmid, mention, count(*) AS n, max(prob) AS prob, arg_max(label, (coalesce(prob, -1), label)) AS label FROM m0 GROUP BY pmid, mention),
mentions AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY pmid, lower(mention) ORDER BY n DESC, prob DESC NULLS LAST, mention) AS rn FROM m1) WHERE rn = 1)"""


def mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ner_union").filter("source = 'v2' and trim(coalesce(entity_text, '')) <> ''")
    rows = rows.select(fx.clean_id("publication_id").alias("pmid"), F.col("entity_text").alias("mention"), F.col("entity_type").alias("label"), F.col("confidence").alias("prob")).filter("pmid is not null")
    per = rows.groupBy("pmid", "mention").agg(F.count("*").alias("n"), F.max("prob").alias("prob"), F.max(F.struct(F.coalesce("prob", F.lit(-1.0)).alias("p"), "label"))["label"].alias("label"))
    return keep_first(per.withColumn("low", F.lower("mention")), ["pmid", "low"], [F.desc("n"), F.desc_nulls_last("prob"), "mention"]).drop("low")


@query(f"WITH {_MENTIONS} SELECT * FROM mentions")
def mention_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Mentions counted, then one spelling per paper: the most frequent, then the surest."""
    return mentions(spark, d)


@query(
    f"""WITH {_MENTIONS} SELECT pmid, coalesce(string_agg(mention, ', ' ORDER BY mention) FILTER (label = 'COM'), '') AS common_name,
 coalesce(string_agg(CAST(CAST(floor(coalesce(prob, 0.0) * 1000) AS BIGINT) AS VARCHAR), ', ' ORDER BY mention) FILTER (label = 'COM'), '') AS common_prob,
 coalesce(string_agg(mention, ', ' ORDER BY mention) FILTER (label = 'FUL'), '') AS full_name,
 coalesce(string_agg(CAST(CAST(floor(coalesce(prob, 0.0) * 1000) AS BIGINT) AS VARCHAR), ', ' ORDER BY mention) FILTER (label = 'FUL'), '') AS full_prob FROM mentions GROUP BY pmid"""
)
def mention_wide(spark: SparkSession, d: str) -> DataFrame:
    """Mentions as one row per paper, with joined lists per label (a pivot over fixed labels)."""
    shown = F.floor(F.coalesce("prob", F.lit(0.0)) * 1000).cast("string")  # in thousandths
    rows = F.array_sort(F.collect_list(F.struct("mention", shown.alias("p"))))
    wide = mentions(spark, d).groupBy("pmid").pivot("label", ["COM", "FUL"]).agg(rows.alias("r"))
    pick = lambda col, part: F.coalesce(F.array_join(F.transform(col, lambda s: s[part]), ", "), F.lit(""))
    return wide.select("pmid", *[pick(F.col(k), p).alias(n) for k, p, n in (("COM", "mention", "common_name"), ("COM", "p", "common_prob"), ("FUL", "mention", "full_name"), ("FUL", "p", "full_prob"))])


_PER_PAPER = f"""{_UNION}, per AS (SELECT pmid, count(DISTINCT lower(trim(entity_text))) AS entity_count, count(DISTINCT CASE WHEN source = 'spacy' THEN lower(trim(entity_text)) END) AS spacy_count,
 count(DISTINCT CASE WHEN source = 'v2' THEN lower(trim(entity_text)) END) AS v2_count, array_to_string(list_sort(list_distinct(list(lower(trim(entity_text))))), ' | ') AS entities FROM merged GROUP BY pmid)"""


def per_paper(spark: SparkSession, d: str) -> DataFrame:
    e = F.lower(F.trim("entity_text"))
    return merged(spark, d).groupBy("pmid").agg(
        F.countDistinct(e).alias("entity_count"), F.countDistinct(F.when(F.col("source") == "spacy", e)).alias("spacy_count"),
        F.countDistinct(F.when(F.col("source") == "v2", e)).alias("v2_count"), F.array_join(F.array_sort(F.collect_set(e)), " | ").alias("entities"),
    )


@query(f"WITH {_PER_PAPER} SELECT * FROM per")
def paper_entities(spark: SparkSession, d: str) -> DataFrame:
    return per_paper(spark, d)


@query(
    f"""WITH {_UNION}, e AS (SELECT DISTINCT lower(trim(entity_text)) AS entity, pmid, source FROM merged)
SELECT entity, count(DISTINCT pmid) AS total_papers, count(DISTINCT CASE WHEN source = 'spacy' THEN pmid END) AS spacy_papers, count(DISTINCT CASE WHEN source = 'v2' THEN pmid END) AS v2_papers,
 CASE WHEN count(*) FILTER (source = 'spacy') > 0 AND count(*) FILTER (source = 'v2') > 0 THEN 'both' WHEN count(*) FILTER (source = 'spacy') > 0 THEN 'spacy_only' ELSE 'v2_only' END AS source,
 array_to_string(list_sort(list_distinct(list(pmid))), ',') AS pmids FROM e GROUP BY entity"""
)
def entity_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Per entity the papers that name it, by system."""
    e = merged(spark, d).select(F.lower(F.trim("entity_text")).alias("entity"), "pmid", "source").distinct()
    s, v = F.count_if(F.col("source") == "spacy") > 0, F.count_if(F.col("source") == "v2") > 0
    return e.groupBy("entity").agg(
        F.countDistinct("pmid").alias("total_papers"), F.countDistinct(F.when(F.col("source") == "spacy", F.col("pmid"))).alias("spacy_papers"),
        F.countDistinct(F.when(F.col("source") == "v2", F.col("pmid"))).alias("v2_papers"), F.when(s & v, "both").when(s, "spacy_only").otherwise("v2_only").alias("source"),
        F.array_join(F.array_sort(F.collect_set("pmid")), ",").alias("pmids"),
    )


@query(
    f"""WITH {_PER_PAPER}, s AS (SELECT 'linguistic' AS name, pmid FROM union_papers_with_primary_resources WHERE in_linguistic UNION ALL SELECT 'setfit', pmid FROM union_papers_with_primary_resources WHERE in_setfit
 UNION ALL SELECT 'union', pmid FROM union_papers_with_primary_resources)
SELECT name, count(*) AS papers, count(per.pmid) AS with_entities, 100.0 * count(per.pmid) / count(*) AS coverage, avg(entity_count) AS mean_entities, CAST(coalesce(sum(spacy_count), 0) AS BIGINT) AS spacy_total,
 CAST(coalesce(sum(v2_count), 0) AS BIGINT) AS v2_total FROM s LEFT JOIN per USING (pmid) GROUP BY name"""
)
def set_stats(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of the paper sets by entities; the three sets share one scan."""
    u = table(spark, d, "union_papers_with_primary_resources").select("pmid", "in_linguistic", "in_setfit")
    sets = F.array_compact(F.array(F.when(F.col("in_linguistic"), "linguistic"), F.when(F.col("in_setfit"), "setfit"), F.lit("union")))
    s = u.select("pmid", F.explode(sets).alias("name")).join(per_paper(spark, d), "pmid", "left")
    return s.groupBy("name").agg(
        F.count("*").alias("papers"), F.count("entity_count").alias("with_entities"), (100.0 * F.count("entity_count") / F.count("*")).alias("coverage"),
        F.avg("entity_count").alias("mean_entities"), F.coalesce(F.sum("spacy_count"), F.lit(0)).alias("spacy_total"), F.coalesce(F.sum("v2_count"), F.lit(0)).alias("v2_total"),
    )


# sets of papers


@query(
    """SELECT coalesce(a.pmid, b.pmid) AS pmid, a.ling_score, b.setfit_confidence, CASE WHEN a.pmid IS NOT NULL AND b.pmid IS NOT NULL THEN 'both' WHEN a.pmid IS NOT NULL THEN 'linguistic_only' ELSE 'setfit_only' END AS source
FROM (SELECT pmid, ling_score FROM union_papers_with_primary_resources WHERE ling_score >= 3.0) a FULL JOIN (SELECT pmid, setfit_confidence FROM union_papers_with_primary_resources WHERE setfit_confidence >= 0.60) b ON a.pmid = b.pmid"""
)
def paper_sets(spark: SparkSession, d: str) -> DataFrame:
    """Union of the linguistic set and the classifier's set, with where each paper came from."""
    from resinv.operators.relational import full_provenance

    u = table(spark, d, "union_papers_with_primary_resources")
    a, b = u.filter("ling_score >= 3.0").select("pmid", "ling_score"), u.filter("setfit_confidence >= 0.60").select("pmid", "setfit_confidence")
    return full_provenance(a, b, "pmid", ("linguistic_only", "setfit_only"))


@query(
    """SELECT count(*) FILTER (in_linguistic AND NOT in_setfit) AS only_linguistic, count(*) FILTER (in_setfit AND NOT in_linguistic) AS only_setfit, count(*) FILTER (in_linguistic AND in_setfit) AS both_sets,
 round(100.0 * count(*) FILTER (in_linguistic AND in_setfit) / count(*) FILTER (in_linguistic OR in_setfit), 6) AS overlap_percent FROM union_papers_with_primary_resources"""
)
def set_overlap(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("in_linguistic"), F.col("in_setfit")
    return table(spark, d, "union_papers_with_primary_resources").agg(
        F.count_if(a & ~b).alias("only_linguistic"), F.count_if(b & ~a).alias("only_setfit"), F.count_if(a & b).alias("both_sets"),
        F.round(100.0 * F.count_if(a & b) / F.count_if(a | b), 6).alias("overlap_percent"),
    )


@query(
    """SELECT coalesce(a.pmid, b.pmid) AS pmid, greatest(coalesce(a.v, 0), coalesce(b.v, 0)) = 1 AS positive FROM
 (SELECT pmid, CAST(ling_score >= 2 AS INTEGER) AS v FROM union_papers_with_primary_resources WHERE ling_score IS NOT NULL) a FULL JOIN
 (SELECT pmid, CAST(setfit_confidence >= 0.5 AS INTEGER) AS v FROM union_papers_with_primary_resources WHERE setfit_confidence IS NOT NULL) b ON a.pmid = b.pmid"""
)
def classifier_or_union(spark: SparkSession, d: str) -> DataFrame:
    """Positive where either of two classifiers says so; a classifier that did not see a paper says no."""
    u = table(spark, d, "union_papers_with_primary_resources")
    a = u.filter("ling_score is not null").select("pmid", (F.col("ling_score") >= 2).cast("int").alias("a"))
    b = u.filter("setfit_confidence is not null").select("pmid", (F.col("setfit_confidence") >= 0.5).cast("int").alias("b"))
    return a.join(b, "pmid", "full").select("pmid", (F.greatest(F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))) == 1).alias("positive"))


@query("SELECT pmid, setfit_confidence, CASE WHEN setfit_confidence >= 0.70 THEN 'high' WHEN setfit_confidence >= 0.60 THEN 'medium' ELSE 'low' END AS tier, CASE WHEN setfit_confidence >= 0.5 THEN 'introduction' ELSE 'usage' END AS label FROM union_papers_with_primary_resources WHERE setfit_confidence IS NOT NULL")
def confidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    from resinv.operators.relational import tier

    u = table(spark, d, "union_papers_with_primary_resources").filter("setfit_confidence is not null")
    s = F.col("setfit_confidence")
    return u.select("pmid", "setfit_confidence", tier(s, [(0.70, "high"), (0.60, "medium")], "low").alias("tier"), F.when(s >= 0.5, "introduction").otherwise("usage").alias("label"))


@query(f"WITH {_UNION}, c AS (SELECT lower(trim(entity_text)) AS entity, count(DISTINCT pmid) AS unique_paper_count, count(*) AS total_paper_count FROM merged GROUP BY 1) SELECT * FROM c WHERE unique_paper_count >= 2")
def entities_of_papers(spark: SparkSession, d: str) -> DataFrame:
    """Entities that two papers or more name."""
    c = merged(spark, d).groupBy(fx.normal_entity("entity_text").alias("entity")).agg(F.countDistinct("pmid").alias("unique_paper_count"), F.count("*").alias("total_paper_count"))
    return min_count(c, 2)
