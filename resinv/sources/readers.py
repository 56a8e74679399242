"""Sources: tables from CSV, text and JSON files, newest files, validated multi-file sets, look-ups with a cache."""

from __future__ import annotations

import glob
import json
import os
import re
from collections.abc import Iterable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resinv.functions import fixed as X
from resinv.functions.text import filled
from resinv.sources import files

DATE = r"^\d{4}(-\d{2}(-\d{2})?)?$"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """A CSV with header and quoted line breaks; without a schema all columns are strings. '' is read as null."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", False)).csv(path)


def read_csv_text(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """All columns as strings, nulls as ''."""
    return read_csv(spark, path, None, encoding).na.fill("")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-blank trimmed lines as ``id``."""
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> ''").distinct()


def read_json_cache(spark: SparkSession, path: str, value: str) -> DataFrame:
    """A JSON object keyed by id as rows ``(id, value)``; ``value`` is the DDL type of its values."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("id", "value"))


def newest(pattern: str | Iterable[str], spark: SparkSession | None = None) -> str | None:
    """The newest file that matches a pattern, the first pattern with a match deciding; with a session on any file
    system it reaches, else on the local one."""
    for p in [pattern] if isinstance(pattern, str) else pattern:
        found = files.listed(spark, p) if spark is not None else [(f, os.path.getmtime(f)) for f in glob.glob(p)]
        if found:
            return max(found, key=lambda x: (x[1], x[0]))[0]
    return None


def first_existing(paths: Iterable[str], spark: SparkSession | None = None) -> str:
    """The first of several paths that exists."""
    paths = list(paths)
    for p in paths:
        if files.exists(spark, p) if spark is not None else os.path.exists(p):
            return p
    raise FileNotFoundError(f"none of {paths} exists")


def valid_date(text: str) -> bool:
    return bool(re.match(DATE, text))


def is_valid_date(x: Column | str) -> Column:
    return filled(x).rlike(DATE)


RESULT_COLUMNS = ["original_record_num", "database_name", "long_database_name", "found_urls", "url_source", "match_quality", "notes"]


def read_results(spark: SparkSession, paths: list[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Result files of searchers as one table with ``file``, and the violations ``(file, record, problem)``.

    Files may lack columns; strict raises if there is a violation.
    """
    out = None
    for p in paths:
        one = read_csv(spark, p)
        for c in RESULT_COLUMNS:
            if c not in one.columns:
                one = one.withColumn(c, F.lit(None).cast("string"))
        one = one.select(*RESULT_COLUMNS, F.lit(os.path.basename(p)).alias("file"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.createDataFrame([], ", ".join(f"{c} string" for c in [*RESULT_COLUMNS, "file"]))
    problem = F.array_compact(
        F.array(
            F.when(F.col("original_record_num").try_cast("long").isNull(), "record number is no number"),
            F.when(filled("database_name") == "", "no name"),
            F.when(~filled("url_source").isin(*X.RECOVERY_SOURCES), "unknown source"),
            F.when(~filled("match_quality").isin("HIGH", "MEDIUM", "LOW", ""), "unknown quality"),
        )
    )
    bad = out.select("file", F.col("original_record_num").alias("record"), F.explode(problem).alias("problem"))
    if strict and (first := bad.head()):
        raise ValueError(f"{first.file}: record {first.record}: {first.problem}")
    return out, bad


class Lookup(Protocol):
    """A look-up of records by id: rows of ``schema`` for a batch of ids; ids that are unknown give none."""

    schema: str

    def fetch(self, ids: list[str]) -> list[tuple]: ...


def look_up(ids: DataFrame, id_col: str, provider: Lookup, cache: DataFrame | None = None, batch: int = 20) -> DataFrame:
    """Records of the ids: from the cache where it has them, the others fetched in batches inside the tasks.

    Null ids are dropped and each id is fetched once.  The provider is sent to the workers; the rows come back
    with its schema, whose first column is the id.
    """
    wanted = ids.select(F.col(id_col).cast("string").alias("_id")).filter("_id is not null").distinct()
    first = provider.schema.split()[0]
    todo = wanted if cache is None else wanted.join(cache.select(F.col(first).alias("_id")), "_id", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in provider.schema.split(", ")]
        for pdf in batches:
            listed = list(pdf["_id"])
            for at in range(0, len(listed), batch):
                yield pd.DataFrame(provider.fetch(listed[at : at + batch]), columns=names)

    fetched = todo.mapInPandas(run, provider.schema)
    if cache is None:
        return fetched
    return fetched.unionByName(cache.join(wanted, cache[first] == wanted["_id"], "left_semi"))


def look_up_in_steps(ids: DataFrame, id_col: str, provider: Lookup, cache: str, steps: int = 10, batch: int = 20) -> DataFrame:
    """The same over a cache table at a path, which grows step by step: what a failed run fetched is kept.

    Ids fall into steps by a hash; each step fetches its ids that the cache lacks and appends them.
    """
    spark = ids.sparkSession
    wanted = ids.select(F.col(id_col).cast("string").alias("_id")).filter("_id is not null").distinct()
    first = provider.schema.split()[0]
    for step in range(steps):
        part = wanted.filter(F.pmod(F.xxhash64("_id"), F.lit(steps)) == step)
        known = spark.read.parquet(cache) if files.exists(spark, cache) else None
        todo = part if known is None else part.join(known.select(F.col(first).alias("_id")), "_id", "left_anti")
        look_up(todo, "_id", provider, None, batch).write.mode("append").parquet(cache)
    held = spark.read.parquet(cache)
    return held.join(wanted, held[first] == wanted["_id"], "left_semi")


def paged(provider, query: str, start: str, end: str, limit: int = 100_000) -> Iterator[list[dict]]:
    """Pages of a paged search: the query with its dates filled in, then every next page until there is none.

    More than ``limit`` pages raise an error, as a search that does not end would.
    """
    for d in (start, end):
        if not valid_date(d):
            raise ValueError(f"no date: {d}")
    url = query.format(start, end)
    for _ in range(limit):
        page = provider(url)
        yield page.get("results", [])
        url = page.get("next")
        if not url:
            return
    raise RuntimeError(f"more than {limit} pages")


def search(spark: SparkSession, provider, query: str, start: str, end: str) -> DataFrame:
    """``(page, record)``: the records of a paged search as JSON, the months of the period searched side by side.

    ``provider`` is sent to the workers; records of two months are told apart by the search itself.
    """
    if not (valid_date(start) and valid_date(end)):
        raise ValueError(f"no dates: {start}, {end}")
    day = lambda t: F.to_date(F.lit({4: f"{t}-01-01", 7: f"{t}-01"}.get(len(t), t)))
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(day(start), "month"), day(end), F.expr("interval 1 month"))).alias("m"))
    months = months.select(F.greatest("m", day(start)).cast("string").alias("a"), F.least(F.last_day("m"), day(end)).cast("string").alias("b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b in zip(pdf["a"], pdf["b"]):
                for n, page in enumerate(paged(provider, query, a, b)):
                    yield pd.DataFrame({"page": [f"{a}:{n}"] * len(page), "record": [json.dumps(r) for r in page]})

    return months.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInPandas(run, "page string, record string")


#: The nested record of a paper search, and its flat form.
PAPER_JSON = (
    "id string, title string, abstractText string, firstPublicationDate string, citedByCount long, pubYear string, "
    "pubTypeList struct<pubType array<string>>, keywordList struct<keyword array<string>>, "
    "meshHeadingList struct<meshHeading array<struct<descriptorName string>>>, "
    "journalInfo struct<journal struct<title string, issn string>>, "
    "authorList struct<author array<struct<fullName string, authorAffiliationDetailsList struct<authorAffiliation array<struct<affiliation string>>>>>>"
)


def flat_papers(df: DataFrame, column: str) -> DataFrame:
    """Papers from a column of JSON texts: lists as JSON arrays, distinct affiliations joined; bad JSON gives nulls."""
    p = df.select(F.from_json(column, PAPER_JSON).alias("p"))
    lists = lambda x: F.to_json(F.coalesce(x, F.array().cast("array<string>")))
    affiliations = F.flatten(F.transform(F.col("p.authorList.author"), lambda a: F.coalesce(F.transform(a["authorAffiliationDetailsList"]["authorAffiliation"], lambda x: x["affiliation"]), F.array().cast("array<string>"))))
    return p.select(
        "p.id", "p.title", F.col("p.abstractText").alias("abstract"), F.col("p.firstPublicationDate").alias("publication_date"), "p.citedByCount",
        F.col("p.pubYear").try_cast("int").alias("pubYear"), lists(F.col("p.pubTypeList.pubType")).alias("pubType"), lists(F.col("p.keywordList.keyword")).alias("keywords"),
        lists(F.transform(F.col("p.meshHeadingList.meshHeading"), lambda m: m["descriptorName"])).alias("meshTerms"), F.col("p.journalInfo.journal.title").alias("journalTitle"),
        F.col("p.journalInfo.journal.issn").alias("journalISSN"), F.array_join(F.array_distinct(affiliations), "; ").alias("authorAffiliations"),
    )
