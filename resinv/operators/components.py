"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resinv.operators.lineage import cut


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """``(node, component)`` for every node of the links; a component is named by its smallest node.

    Nulls and links of a node to itself are ignored, repeated links count once, no links give no row.  Each
    round replaces links by links to smaller neighbours, so no node's neighbours are ever collected; the
    number of rounds grows with the logarithm of the longest path; more than ``max_rounds`` raise an error.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node links to the smallest of the node and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: every smaller neighbour of a node, and the node, link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least.hint("merge"), "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = cut(small)
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    return e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
