"""Queries on fields that hold several values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resinv.operators.packed import split_packed
from resinv.plans.registry import query, table

FIELDS = {"ID": "id", "authors": "person", "grant_agencies": "organisation", "paper_titles": "title"}
COUNTS = {"ID": "article_count", "paper_titles": "article_count"}


@query()
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every value packed in the inventory's cells, with record, field and position."""
    return split_packed(table(spark, d, "final_inventory"), "record_num", FIELDS, COUNTS).distinct()


@query()
def p2_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each value occurs in each packed field, and in how many records."""
    values = split_packed(table(spark, d, "final_inventory"), "record_num", FIELDS, COUNTS)
    return values.groupBy("field", "value").agg(F.count("*").alias("times"), F.countDistinct("record_num").alias("records"))
