"""Sinks: one CSV file, id lists, statistics, reports, chunks, safe replacement."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resinv.operators.relational import chunk_numbers, review_parts
from resinv.sources import files


def _single(spark: SparkSession, folder: str, suffix: str, target: str) -> str:
    part = next(p for p, _ in files.listed(spark, f"{folder}/part-*{suffix}"))
    if files.exists(spark, target):
        files.remove(spark, target)
    files.move(spark, part, target)
    files.remove(spark, folder)
    return target


def write_csv(df: DataFrame, path: str, quote_all: bool = False, single: bool = False) -> str:
    """A CSV with header: a folder of parts, or with ``single`` one file, written by one task (for small results)."""
    writer = (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", quote_all)
    if not single:
        writer.csv(path)
        return path
    writer.csv(path + ".parts")
    return _single(df.sparkSession, path + ".parts", ".csv", path)


def write_ids(df: DataFrame, column: str, path: str) -> str:
    """Distinct ids, one a line, in the order of their numbers."""
    ids = df.select(F.col(column).cast("string").alias("value")).filter("value is not null and trim(value) <> ''").distinct()
    ids.orderBy(F.col("value").try_cast("long"), "value").coalesce(1).write.mode("overwrite").text(path + ".parts")
    return _single(df.sparkSession, path + ".parts", ".txt", path)


def write_statistics(df: DataFrame, path: str) -> dict:
    """A one-row table as a JSON document."""
    row = df.head()
    stats = {} if row is None else row.asDict(recursive=True)
    files.write_text(df.sparkSession, path, json.dumps(stats, indent=2, default=str))
    return stats


def write_report(title: str, sections: dict[str, DataFrame], path: str, rows: int = 50) -> str:
    """A Markdown report with one table per section, each of at most ``rows`` lines."""
    lines = [f"# {title}", ""]
    for name, df in sections.items():
        lines += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        lines += ["| " + " | ".join(str(v).replace("|", "\\|") for v in r) + " |" for r in df.limit(rows).collect()]
        lines.append("")
    if sections:
        files.write_text(next(iter(sections.values())).sparkSession, path, "\n".join(lines))
    return path


def write_chunks(df: DataFrame, order: list[str], chunks: int, path: str, brief: str | None = None) -> str:
    """The table in folders ``chunk=1..n`` of nearly equal size; ``brief`` is a text for those who work on them, to
    which the size of each chunk is added, written as ``BRIEF.md``."""
    numbered = chunk_numbers(df, order, chunks)
    numbered.write.mode("overwrite").partitionBy("chunk").option("header", True).csv(path)
    if brief is not None:
        sizes = numbered.groupBy("chunk").count().orderBy("chunk").collect()  # one row a chunk
        files.write_text(df.sparkSession, f"{path}/BRIEF.md", "\n".join([brief, "", *[f"- chunk {r['chunk']}: {r['count']} rows" for r in sizes], ""]))
    return path


def replace_table(df: DataFrame, path: str) -> str | None:
    """Writes a parquet table beside ``path``, keeps the old one as a backup and swaps; the backup's path."""
    spark = df.sparkSession
    fresh, backup = f"{path}.new", f"{path}.backup-{int(time.time() * 1000)}"
    df.write.mode("overwrite").parquet(fresh)
    had = files.exists(spark, path)
    if had:
        files.move(spark, path, backup)
    files.move(spark, fresh, path)
    return backup if had else None


def write_model(model, path: str, spark: SparkSession, metrics: dict | None = None) -> str:
    """A fitted pipeline model with its metrics beside it, as ``model`` and ``metrics.json``."""
    model.write().overwrite().save(f"{path}/model")
    files.write_text(spark, f"{path}/metrics.json", json.dumps(metrics or {}, indent=2, default=str))
    return path


def review_outputs(df: DataFrame, folder: str) -> list[str]:
    """The side outputs for people, one CSV each."""
    return [write_csv(part, f"{folder}/{name}.csv") for name, part in review_parts(df).items()]
