"""The general idioms on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resinv.operators import relational as R
from resinv.plans.registry import query, table


@query("SELECT * EXCLUDE (rn) FROM (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    """The first order of each customer."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return R.keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT * EXCLUDE (m) FROM (SELECT l_orderkey, l_linenumber, l_quantity, max(l_quantity) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WHERE l_quantity = m")
def keep_best_with_ties(spark: SparkSession, d: str) -> DataFrame:
    """All lines of the largest quantity of each order."""
    return R.keep_ties(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_quantity")


@query("SELECT * FROM (SELECT o_orderkey, o_custkey, o_orderpriority, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS members FROM orders) WHERE members > 1")
def dup_all_members(spark: SparkSession, d: str) -> DataFrame:
    return R.all_members(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey", "o_orderpriority"])


@query("SELECT c_mktsegment AS value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM customer GROUP BY 1")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.value_counts(table(spark, d, "customer"), "c_mktsegment")


@query("SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_orderpriority").alias("priorities"), F.countDistinct(F.to_date("o_orderdate")).alias("days"))


@query("SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS mean, median(l_quantity) AS median, min(l_quantity) AS least, max(l_quantity) AS most, stddev_samp(l_quantity) AS spread, quantile_cont(l_quantity, 0.75) AS upper FROM lineitem GROUP BY 1")
def numeric_summary(spark: SparkSession, d: str) -> DataFrame:
    q = "l_quantity"
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.avg(q).alias("mean"), F.percentile(q, 0.5).alias("median"), F.min(q).alias("least"), F.max(q).alias("most"), F.stddev_samp(q).alias("spread"), F.percentile(q, 0.75).alias("upper"),
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
def bottom_k(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(20)


@query("SELECT pmid AS id FROM union_papers_with_primary_resources UNION SELECT pmid FROM papers_with_scanner_scores")
def set_union(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "union_papers_with_primary_resources").select(F.col("pmid").alias("id")), table(spark, d, "papers_with_scanner_scores").select(F.col("pmid").alias("id"))
    return a.union(b).distinct()


@query("SELECT pmid AS id FROM union_papers_with_primary_resources INTERSECT SELECT pmid FROM papers_with_scanner_scores")
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "union_papers_with_primary_resources").select(F.col("pmid").alias("id")), table(spark, d, "papers_with_scanner_scores").select(F.col("pmid").alias("id"))
    return a.intersect(b)


@query("SELECT pmid AS id FROM union_papers_with_primary_resources EXCEPT SELECT pmid FROM papers_with_scanner_scores")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "union_papers_with_primary_resources").select(F.col("pmid").alias("id")), table(spark, d, "papers_with_scanner_scores").select(F.col("pmid").alias("id"))
    return a.subtract(b)


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def semi_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "left_semi")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "left_anti")


@query("SELECT c_custkey, coalesce(n, 0) AS n, coalesce(total, 0.0) AS total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS total FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def left_join_default(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("total"))
    return R.lookup_default(table(spark, d, "customer").select("c_custkey"), per, "c_custkey", {"n": 0, "total": 0.0})


@query("SELECT coalesce(a.k, b.k) AS k, a.n AS orders, b.n AS suppliers, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'customers_only' ELSE 'suppliers_only' END AS source FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k")
def full_outer_provenance(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("orders"))
    b = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return R.full_provenance(a, b, "k", ("customers_only", "suppliers_only"))


@query("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_field(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS as_number, row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS position FROM orders")
def sort_ids_as_text(spark: SparkSession, d: str) -> DataFrame:
    """Ids with their position in the order of their text, which differs from their order as numbers."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("as_number"))
    return R.positions(o, ["id"])


@query("SELECT o_orderkey, p, row_number() OVER (ORDER BY p, o_orderkey) AS position FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END AS p FROM orders)")
def sort_by_priority(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their position by priority, then key."""
    p = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    return R.positions(table(spark, d, "orders").select("o_orderkey", p.alias("p")), ["p", "o_orderkey"])


_HASH = lambda x, seed: f"('0x' || substr(md5('{seed}|' || {x}), 1, 8))::BIGINT"


@query(f"SELECT o_orderkey FROM orders ORDER BY {_HASH('CAST(o_orderkey AS VARCHAR)', 42)}, CAST(o_orderkey AS VARCHAR) LIMIT 100")
def random_sample(spark: SparkSession, d: str) -> DataFrame:
    """A seeded sample of 100 orders; the sample is the feature."""
    from resinv.operators.sampling import sample_n

    return sample_n(table(spark, d, "orders").select("o_orderkey"), 100, 42)


@query(
    f"""WITH h AS (SELECT ({_HASH('CAST(o_orderkey AS VARCHAR)', 42)} % 1000000) / 1000000.0 AS x FROM orders)
SELECT CASE WHEN x < 0.7 THEN 'train' WHEN x < 0.85 THEN 'val' ELSE 'test' END AS part, count(*) AS n FROM h GROUP BY 1"""
)
def seeded_split(spark: SparkSession, d: str) -> DataFrame:
    """A seeded three-way split of the orders, counted; a row's part depends on its key alone."""
    from resinv.operators.sampling import split

    parts = split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", {"train": 0.7, "val": 0.15, "test": 0.15}, 42)
    return parts.groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT n_regionkey, n_name, count(*) AS customers, sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END)::BIGINT AS in_credit FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey", "n_name")
    j = table(spark, d, "customer").select("c_nationkey", "c_acctbal").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_regionkey", "n_name").agg(F.count("*").alias("customers"), F.count_if(F.col("c_acctbal") > 0).alias("in_credit"))


@query("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def daily_events(spark: SparkSession, d: str) -> DataFrame:
    """The batch twin of the streaming stage."""
    e = table(spark, d, "events")
    return e.groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS day, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def stream_daily_events(spark: SparkSession, d: str) -> DataFrame:
    """Windowed counts of a stream over the events, run to its end; one row a type and day is kept in memory."""
    from resinv.streaming.incremental import EVENTS, windowed_counts

    stream = spark.readStream.schema(EVENTS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{d}/events.parquet*")
    name = f"daily_events_{abs(hash(d))}"
    q = windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).select("event_type", F.col("window.start").alias("day"), "n", F.round("total", 6).alias("total"))


_WORDS = "' ' || trim(regexp_replace(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"


@query(
    f"""WITH n AS (SELECT DISTINCT trim({_WORDS.format('primary_entity_short')}) AS name FROM union_papers_with_primary_resources WHERE trim({_WORDS.format('primary_entity_short')}) <> ''),
t AS (SELECT DISTINCT doc_id, {_WORDS.format('text')} AS t FROM documents) SELECT doc_id, name FROM t JOIN n ON contains(t, ' ' || name || ' ')"""
)
def dictionary_entities(spark: SparkSession, d: str) -> DataFrame:
    """Known short names found in the documents as whole words."""
    from resinv.sources.providers import dictionary_entities as find

    names = table(spark, d, "union_papers_with_primary_resources").select("primary_entity_short")
    return find(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", names, "primary_entity_short").select("doc_id", "name")


@query()
def classifier_scores(spark: SparkSession, d: str) -> DataFrame:
    """Title and abstract classified as introduction or not by a model fitted on the papers both methods saw."""
    from resinv.functions.text import classifier_text
    from resinv.sources.providers import TextClassifier

    u = table(spark, d, "union_papers_with_primary_resources").select("pmid", classifier_text("title", "abstract").alias("text"), (F.col("ling_score") >= 2).cast("int").alias("label"))
    return TextClassifier("text").fit(u, "label").score(u.select("pmid", "text")).select("pmid", "prediction", F.round("confidence", 6).alias("confidence"))


@query(
    r"""WITH w AS (SELECT pmid, unnest(regexp_split_to_array(coalesce(title, ''), '\s+')) AS w FROM union_papers_with_primary_resources)
SELECT pmid, trim(w, '.,;:()[] ') AS mention, 'COM' AS label, CAST(1.0 AS DOUBLE) AS prob FROM w WHERE regexp_matches(w, '^[A-Z]\w*[A-Z]')"""
)
def folded_tags(spark: SparkSession, d: str) -> DataFrame:
    """Sentences tagged by capitals, folded to entities."""
    from resinv.operators.tags import fold_tags

    w = F.split(F.coalesce("title", F.lit("")), r"\s+")
    p = table(spark, d, "union_papers_with_primary_resources").select("pmid", w.alias("w")).select("pmid", "w", F.transform("w", lambda x: F.when(x.rlike(r"^[A-Z]\w*[A-Z]"), "B-COM").otherwise("O")).alias("t"))
    folded = p.select("pmid", F.explode(fold_tags("w", "t", F.transform("w", lambda x: F.lit(1.0)))).alias("e"))
    return folded.select("pmid", "e.mention", "e.label", "e.prob")
