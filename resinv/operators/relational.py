"""Relational idioms with a defined order: keep first, keep best, group merge, provenance union, list joins.

Tables have no row order, so every pick names the columns that decide it; ties that remain are broken by all
further columns the caller gives.  Nulls sort first ascending and last descending, as the callers' Columns say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resinv.functions.text import c
from resinv.operators.lineage import cut


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key (null keys are one group), the first by the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_ties(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    """All rows of each key whose score is the key's largest; rows with a null score never are."""
    best = F.max(score).over(Window.partitionBy(*keys))
    return df.withColumn("_m", best).filter(F.col(score) == F.col("_m")).drop("_m")


def all_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key occurs more than once, with ``members``, the number of rows of the key."""
    return df.withColumn("members", F.count("*").over(Window.partitionBy(*keys))).filter("members > 1")


def full_provenance(a: DataFrame, b: DataFrame, key: str, names: tuple[str, str], both: str = "both") -> DataFrame:
    """Full outer union by key with ``source``; each side must hold a key at most once."""
    left, right = a.withColumn("_a", F.lit(1)), b.withColumn("_b", F.lit(1))
    out = left.join(right, key, "full")
    source = F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), both).when(F.col("_a").isNotNull(), names[0]).otherwise(names[1])
    return out.withColumn("source", source).drop("_a", "_b")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, percent)`` of a column; null is a value of its own."""
    n = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return n.select("value", "n", F.round(100.0 * F.col("n") / df.agg(F.count("*")).scalar(), 6).alias("percent"))


def ordered_join(value: Column, order: Column, separator: str = ", ") -> Column:
    """The non-null values of a group as one string, in the given order."""
    sorted_ = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.array_join(F.transform(sorted_, lambda s: s["v"]), separator)


def first_filled(value: Column, order: Column) -> Column:
    """The value of a group's first row that has one."""
    return F.min(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))["v"]


def list_lookup(df: DataFrame, keys: Column, table: DataFrame, key: str, value: str) -> DataFrame:
    """For each row the sorted distinct values of a lookup table over the keys of a list; [] if there are none.

    ``df`` needs a column ``row`` that names its rows.
    """
    pairs = df.select("row", F.explode(keys).alias(key)).distinct().join(table.select(key, value).distinct(), key)
    found = pairs.filter(F.col(value).isNotNull()).groupBy("row").agg(F.array_sort(F.collect_set(value)).alias("found"))
    return df.join(found, "row", "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))


def first_hit(df: DataFrame, keys: Column, table: DataFrame, key: str, value: str) -> DataFrame:
    """For each row the value of the first key, in list order, that the lookup table has a value for."""
    pairs = df.select("row", F.posexplode(keys).alias("pos", key)).join(table.select(key, value), key).filter(F.col(value).isNotNull())
    best = pairs.groupBy("row").agg(F.min(F.struct("pos", F.col(value).alias("hit"), F.col(key).alias("hit_key"))).alias("b"))
    return df.join(best.select("row", F.col("b.hit").alias("hit"), F.col("b.hit_key").alias("hit_key")), "row", "left")


def positions(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """The rows with their position from 1 in a total order of the table.

    Positions come from one sort by range: each range adds the sizes of the ranges before it, so no table is
    sorted in one task.  Rows that tie in ``order`` get positions in any order; callers name columns enough.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()))
    sizes = placed.groupBy("_p").agg(F.count("*").alias("_s"))  # one row per range
    starts = sizes.select("_p", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) + F.col("_before")
    return placed.join(F.broadcast(starts), "_p").withColumn(name, at.cast("long")).drop("_p", "_before")


def chunk_numbers(df: DataFrame, order: list[str], chunks: int) -> DataFrame:
    """``chunk`` from 1, so that chunks are of nearly equal size, larger ones first."""
    placed = positions(df, order, "_at")
    total = placed.agg(F.count("*")).scalar()
    at = F.col("_at") - 1
    big = F.floor(total / chunks) + 1
    many = total % chunks
    small = F.greatest(F.floor(total / chunks), F.lit(1))
    number = F.when(at < many * big, F.floor(at / big)).otherwise(many + F.floor((at - many * big) / small)) + 1
    return placed.withColumn("chunk", number.cast("long")).drop("_at")


def min_count(df: DataFrame, least: int, columns: tuple[str, ...] = ("unique_paper_count", "total_paper_count")) -> DataFrame:
    """The rows whose count is at least ``least``, by the first of the columns that the table has; all if it has none."""
    known = next((n for n in columns if n in df.columns), None)
    return df if known is None else df.filter(F.col(known) >= least)


def tier(value: Column, bounds: list[tuple[float, str]], lowest: str) -> Column:
    """The label of the first bound, from high to low, that the value reaches; null gives the lowest."""
    out = F.when(F.lit(False), "")
    for bound, label in bounds:
        out = out.when(value >= bound, label)
    return out.otherwise(lowest)


def lookup_default(df: DataFrame, table: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left join to a table that holds a key once, nulls replaced by the defaults."""
    out = df.join(table.select(key, *defaults), key, "left")
    for name, value in defaults.items():
        out = out.withColumn(name, F.coalesce(c(name), F.lit(value)))
    return out


def prefixed(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """All columns but the key with a prefix, so that a join brings no clashing names."""
    return df.select(F.col(key), *[F.col(n).alias(f"{prefix}{n}") for n in df.columns if n != key])


def priority_lookup(df: DataFrame, tables: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """Left join to the first of several tables that knows a key; within a table the smallest row decides."""
    ranked = None
    for rank, t in enumerate(tables):
        one = t.select(key, *columns).withColumn("_rank", F.lit(rank))
        ranked = one if ranked is None else ranked.unionByName(one)
    return df.join(keep_first(ranked, [key], ["_rank", *columns]).drop("_rank"), key, "left")


def column_check(df: DataFrame, reference: list[str]) -> dict[str, list[str]]:
    """Columns that are missing, not known, or out of the reference's order."""
    known = [n for n in df.columns if n in reference]
    wanted = [n for n in reference if n in df.columns]
    return {"missing": [n for n in reference if n not in df.columns], "unknown": [n for n in df.columns if n not in reference], "moved": [a for a, b in zip(known, wanted) if a != b]}


def review_parts(df: DataFrame) -> dict[str, DataFrame]:
    """Side outputs of an inventory for people: renamed records, URLs to review, records left out for want of a URL."""
    conditions = {
        "modified_names": F.coalesce(F.col("name_modification_flags"), F.lit("")) != "",
        "urls_to_review": F.col("url_validation") == "review",
        "excluded": F.coalesce(F.trim("extracted_url"), F.lit("")) == "",
    }
    return {name: df.filter(cond) for name, cond in conditions.items()}
