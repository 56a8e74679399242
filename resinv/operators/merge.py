"""Merging papers of one resource: filter by profile, cluster by URL host, group by host and name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resinv.functions import text as fx
from resinv.functions.urls import authority, with_scheme
from resinv.operators.relational import first_filled, ordered_join

FIRST = ["title", "abstract", "in_linguistic", "in_setfit", "ling_score", "setfit_confidence", "primary_entity_long", "primary_entity_short", "status", "resource_url"]


def resource_key(df: DataFrame) -> DataFrame:
    """With ``host`` of the URL and ``norm_entity`` of the long, else the short name ('' where there is none)."""
    name = F.coalesce(F.nullif(F.trim("primary_entity_long"), F.lit("")), F.nullif(F.trim("primary_entity_short"), F.lit("")), F.lit(""))
    return df.withColumn("host", authority(with_scheme(F.col("resource_url")))).withColumn("norm_entity", fx.loose_entity(name))


def merge_resources(df: DataFrame) -> DataFrame:
    """One row per (host, entity): papers listed in id order, first filled values, largest scores, token unions.

    Rows without a URL share the empty host and are kept, unlike in a plain group-by on null keys.  A paper
    that comes from two inputs is listed and counted once.  Papers without name and URL merge into one row
    per missing pair.  The list of papers is the result's own; nothing else of a group is gathered but its distinct
    pieces.
    """
    keyed = resource_key(df)
    keys = ["host", "norm_entity"]
    once = keyed.dropDuplicates([*keys, "pmid"])
    pick = [first_filled(F.col(c), F.col("pmid")).alias(c) for c in FIRST]
    per = once.groupBy(*keys).agg(
        ordered_join(F.col("pmid"), F.col("pmid")).alias("pmid"),
        *pick,
        F.max("primary_score").alias("primary_score"),
        F.max("ner_confidence").alias("ner_confidence"),
        F.count("*").alias("article_count"),
    )
    # the pieces of both packed columns become rows and are made distinct in every task before they are gathered
    piece = lambda c: F.transform(F.split(F.coalesce(c, F.lit("")), "[|]"), lambda x: F.struct(F.lit(c).alias("of"), F.trim(x).alias("piece")))
    pieces = once.select(*keys, F.explode(F.concat(piece("all_long"), piece("all_short"))).alias("x")).select(*keys, "x.*").filter("piece not in ('', 'nan')").distinct()
    packed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(F.col("of") == c, F.col("piece")))), " | ").alias(c)
    tokens = pieces.groupBy(*keys).agg(packed("all_long"), packed("all_short"))
    out = per.join(tokens, keys, "left").na.fill({"all_long": "", "all_short": ""})
    return out.select(*keys, "pmid", *FIRST, "primary_score", "ner_confidence", "all_long", "all_short", "article_count")
