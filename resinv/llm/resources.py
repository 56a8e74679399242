"""Which resource a record of the inventory or a paper of the union speaks of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resinv.llm.variants import name_classes
from resinv.operators.lineage import cut

# Path segments that say nothing about what is served there.
GENERIC_SEGMENTS = "db data index home search main web www about browse download".split()


def url_host(url: Column) -> Column:
    """The lower-cased host without www., '' if the text is no http(s) or ftp URL with a host."""
    return F.regexp_extract(F.lower(F.trim(url)), r"^(?:https?|ftp)://(?:[^/@\s]*@)?(?:www\.)?([^/?#:\s]+)", 1)


def url_alias(url: Column) -> Column:
    """The short name a URL gives its resource: a telling path segment, else the host's first label."""
    path = F.regexp_replace(F.regexp_extract(F.lower(F.trim(url)), r"^[a-z]+://[^/?#]+(/[^?#]*)", 1), r"/index\.\w+$", "")
    segment = F.regexp_extract(path, r"/~?([a-z0-9_-]{5,})/?$", 1)
    label = F.regexp_extract(url_host(url), r"^([a-z0-9-]{5,})\.", 1)
    alias = F.when((segment != "") & ~segment.isin(GENERIC_SEGMENTS), segment).otherwise(label)
    return F.when(url_host(url) != "", F.nullif(alias, F.lit("")))


def is_name(name: Column) -> Column:
    return F.coalesce(~F.upper(F.trim(name)).isin("", "N/A", "-"), F.lit(False))


def readable_date(text: Column) -> Column:
    """The date a text gives, missing month or day as 01; null if it is unreadable."""
    parts = r"^(\d{4})(?:[-/.](\d{1,2})(?:[-/.](\d{1,2}))?)?(?:[T ].*)?$"
    t = F.trim(text)
    year, month, day = (F.regexp_extract(t, parts, i) for i in (1, 2, 3))
    iso = F.concat(year, F.lit("-"), F.lpad(F.when(month == "", "01").otherwise(month), 2, "0"), F.lit("-"), F.lpad(F.when(day == "", "01").otherwise(day), 2, "0"))
    return F.when((year != "") & (year != "0000"), F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"))


def occurrences(inventory: DataFrame, union: DataFrame) -> DataFrame:
    """``(row, name, weight)``: every name a row gives its resource, URL aliases included."""
    inv = inventory.select(
        F.concat(F.lit("i"), F.col("record_num")).alias("row"),
        F.explode(
            F.array(
                F.struct(F.col("best_full").alias("name"), F.lit(4).alias("weight")),
                F.struct(F.col("best_name").alias("name"), F.lit(3).alias("weight")),
                F.struct(F.col("best_common").alias("name"), F.lit(2).alias("weight")),
                F.struct(url_alias(F.col("extracted_url")).alias("name"), F.lit(1).alias("weight")),
            )
        ).alias("x"),
    )
    uni = union.select(
        F.concat(F.lit("u"), F.col("pmid")).alias("row"),
        F.explode(F.array(F.struct(F.col("primary_entity_long").alias("name"), F.lit(4).alias("weight")), F.struct(F.col("primary_entity_short").alias("name"), F.lit(2).alias("weight")))).alias("x"),
    )
    return inv.unionByName(uni).select("row", "x.name", "x.weight").filter("name is not null and trim(name) <> ''")


def record_classes(inventory: DataFrame, union: DataFrame) -> DataFrame:
    """``(record_num, class)``: the resource of each record, by the weightiest of the names it gives.

    Records without any name or URL give no row.
    """
    occ = occurrences(inventory, union)
    classes = name_classes(occ)
    votes = occ.filter("row like 'i%'").hint("merge").join(classes, "name").groupBy("row", "class").agg(F.sum("weight").alias("v"))
    best = votes.groupBy("row").agg(F.max(F.struct("v", "class"))["class"].alias("class"))
    return best.select(F.expr("cast(substring(row, 2) as long)").alias("record_num"), "class")


def with_group(inventory: DataFrame, union: DataFrame) -> DataFrame:
    """The inventory with ``group_num``, the smallest record number of the same resource."""
    w = Window.partitionBy("class")
    numbered = cut(record_classes(inventory, union).select("record_num", F.min("record_num").over(w).alias("group_num")))
    return inventory.join(numbered.hint("merge"), "record_num", "left").withColumn("group_num", F.coalesce("group_num", "record_num"))
