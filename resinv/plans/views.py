"""The tables as the queries see them: one row per paper, one per scanned paper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resinv.operators.relational import keep_first
from resinv.plans.registry import table


def papers(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The first harvested row of each non-blank id; only the named columns are read."""
    need = list(dict.fromkeys(["id", "harvested_at", "title", "abstract", *columns]))
    rows = table(spark, d, "papers_metadata").select(*need).filter("trim(coalesce(id, '')) <> ''")
    out = keep_first(rows, ["id"], ["harvested_at", "title", "abstract"])
    return out.select("id", *columns) if columns else out


def scans(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The latest scan of each paper."""
    rows = table(spark, d, "papers_with_scanner_scores")
    out = keep_first(rows, ["pmid"], [F.desc_nulls_last("scanned_at"), F.desc_nulls_last("url_scanner_score"), F.asc_nulls_first("resource_url")])
    return out.select("pmid", *columns) if columns else out
