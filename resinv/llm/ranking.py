"""One ranking from several differently-scaled scores: robust rank aggregation.

Each score becomes a normalised rank (1 is the best item; ties share their mean rank; the divisor is the number
of items that have the score), so no scale can dominate.  Per item the normalised ranks are sorted, and for the
k-th smallest the probability is taken that the k-th smallest of n uniform ranks is as small - a beta order
statistic.  The smallest of these, corrected for the n looks by Bonferroni, is the item's significance, by
which items are ranked.

Ranks are computed without sorting a table in one task: each score is first counted per distinct value, then
the values are range-partitioned; every range adds its own running count to the total of the ranges before it,
of which there is one number per range.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resinv.operators.lineage import cut


SALTS = 64


def _before(parts: DataFrame, *keys: str) -> DataFrame:
    """With ``before``: the sizes of the ranges before each range, one row per range."""
    order = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))


def mean_ranks(items: DataFrame, scores: list[str]) -> DataFrame:
    """``(score, value, r)``: for each distinct value of each score (by number) the mean rank of its items over the
    number of scored items.

    Nulls and NaN are no scores.  All items of one value share one row, so a hot value is one row.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("score"), F.col(s).cast("double").alias("value")) for i, s in enumerate(scores)])
    values = items.select(F.explode(pairs).alias("x")).select("x.*").filter("value is not null and not isnan(value)").groupBy("score", "value").agg(F.count("*").alias("c"))
    placed = cut(values.repartitionByRange("score", F.desc("value")).withColumn("part", F.spark_partition_id()))
    parts = placed.groupBy("score", "part").agg(F.sum("c").alias("size"))
    starts = _before(parts, "score").withColumn("total", F.sum("size").over(Window.partitionBy("score")))
    within = Window.partitionBy("score", "part").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumn("upto", F.sum("c").over(within))
    r = (F.col("before") + F.col("upto") - F.col("c") + (F.col("c") + 1) / 2.0) / F.col("total")
    return running.join(starts.drop("size"), ["score", "part"]).select("score", "value", r.alias("r"))


def significant(x: Column, digits: int = 10) -> Column:
    """A number rounded to so many significant digits, so that equal sums of different order stay equal."""
    return F.format_string(f"%.{digits - 1}e", x).cast("double")


def beta_order(x: Column, k: int, n: int) -> Column:
    """P(the k-th smallest of n uniforms <= x), a finite binomial sum."""
    terms = [F.lit(float(math.comb(n, j))) * F.pow(x, F.lit(float(j))) * F.pow(1.0 - x, F.lit(float(n - j))) for j in range(k, n + 1)]
    return reduce(lambda a, b: a + b, terms)


def rank_aggregate(items: DataFrame, key: str, scores: list[str]) -> DataFrame:
    """``(key, scored, rho, rank)`` for every item, rank 1 the most significant.

    A null or NaN score takes no part (``scored`` counts the others); an item without any score has rho 1 and
    ranks last; ties in rho share the smallest rank.  Null keys are kept as items; repeated rows of a key
    count as items each, so callers make keys unique first; an empty table gives an empty result.
    """
    narrow = items.select(F.col(key).alias("key"), *[F.col(s).cast("double").alias(f"s{i}") for i, s in enumerate(scores)])
    out = narrow
    ranks = cut(mean_ranks(narrow, [f"s{i}" for i in range(len(scores))]))
    for i in range(len(scores)):
        # items without the score are spread by a salt that no rank has, so that nulls make no hot key; adaptive
        # execution splits hot values
        own = ranks.filter(F.col("score") == i).select(F.col("value").alias(f"s{i}"), F.lit(0).alias("salt"), F.col("r").alias(f"r{i}"))
        has = F.coalesce(~F.isnan(f"s{i}"), F.lit(False)) & F.col(f"s{i}").isNotNull()
        out = out.withColumn("salt", F.when(has, 0).otherwise(1 + F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))).join(own, [f"s{i}", "salt"], "left").drop("salt")
    r = F.array_sort(F.array_compact(F.array(*[F.col(f"r{i}") for i in range(len(scores))])))
    out = out.withColumn("r", r).withColumn("scored", F.size("r"))
    rho = F.lit(1.0)
    for n in range(1, len(scores) + 1):
        looks = [beta_order(F.element_at("r", k), k, n) for k in range(1, n + 1)]
        least = looks[0] if n == 1 else F.least(*looks)
        rho = F.when(F.col("scored") == n, F.least(F.lit(1.0), n * least)).otherwise(rho)
    scored = cut(out.select("key", "scored", significant(rho).alias("rho")))
    places = scored.groupBy("rho").agg(F.count("*").alias("c"))
    placed = cut(places.repartitionByRange("rho").withColumn("part", F.spark_partition_id()))
    starts = _before(placed.groupBy("part").agg(F.sum("c").alias("size")))  # one row per range
    upto = F.sum("c").over(Window.partitionBy("part").orderBy("rho").rowsBetween(Window.unboundedPreceding, 0))
    ranked = placed.withColumn("upto", upto).join(starts.drop("size"), "part").select("rho", (F.col("before") + F.col("upto") - F.col("c") + 1).alias("rank"))
    return scored.join(ranked, "rho").select(F.col("key").alias(key), "scored", "rho", "rank")
