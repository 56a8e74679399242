"""Clusters of URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resinv.functions.urls import authority, normal_aggressive, normal_strict, reached_ratio, url_components, url_similarity, with_scheme
from resinv.operators.components import components
from resinv.operators.lineage import cut


def host_clusters(df: DataFrame, order: str, url: str) -> DataFrame:
    """``(order, url, canonical, members)``: all URLs of one host are one cluster, its first URL canonical.

    Within a host any two URLs are similar above every threshold up to 0.9, so comparing pairs adds nothing.
    One aggregate per host - map-side combined, so a host that holds a third of all rows costs one row a task -
    and one join back; a blank URL has the empty host.
    """
    h = df.select(F.col(order), F.col(url).alias("url"), authority(with_scheme(F.col(url))).alias("_h"))
    per = h.groupBy("_h").agg(F.min(F.struct(F.col(order).alias("o"), F.col("url").alias("u")))["u"].alias("canonical"), F.count("*").alias("members"))
    return h.join(per, "_h").select(order, "url", "canonical", "members")


def _parts(df: DataFrame, url: str) -> DataFrame:
    """Every distinct URL with its strict and aggressive form, its components and its block.

    The block is the domain without its ending, so hosts of one name under several endings meet.
    """
    distinct = df.select(F.col(url).alias("u")).filter("u is not null").distinct()
    parts = F.struct(*[v.alias(k) for k, v in url_components("u").items()])
    return distinct.select("u", normal_strict("u").alias("n"), normal_aggressive("u").alias("g"), parts.alias("p")).withColumn("block", F.col("p.domain"))


def _rated(left: DataFrame, right: DataFrame, condition: str) -> DataFrame:
    """``(a, b, similarity)`` of the pairs of a block that meet the condition; a is the smaller URL."""
    a, b = (x.select("block", *[F.col(c).alias(f"{c}{k}") for c in ("u", "n", "g", "p")]) for x, k in ((left, "a"), (right, "b")))
    pairs = a.join(b.hint("merge"), "block").filter(condition)
    da, db = ({k: F.col(f"p{x}.{k}") for k in ("domain", "tld", "path", "full_domain", "subdomain")} for x in "ab")
    # the ratio depends on the order of its texts: in a fixed order, URLs of the same parts get the same ratio
    # within a block the domain is the same, and the other ratios count only above 0.8
    ratios = [reached_ratio(F.least(da[k], db[k]), F.greatest(da[k], db[k]), 0.8).alias(f"_{k}") for k in ("path", "subdomain")]
    equal = (F.col("ga") == F.col("gb")) | ((F.col("na") == F.col("nb")) & (F.col("na") != ""))
    score = url_similarity(da, db, equal, F.lit(1.0), F.col("_path"), F.col("_subdomain"))
    return pairs.select("*", *ratios).select(F.col("ua").alias("a"), F.col("ub").alias("b"), score.alias("similarity"))


def similar_urls(df: DataFrame, url: str, threshold: float) -> DataFrame:
    """``(a, b, similarity)`` of all pairs of distinct URLs that share a registered name, at or above the threshold.

    a is the smaller URL.  Every pair of a name is compared, within a host and across hosts, so the cost, as the
    result at a low threshold, is the square of the URLs a name has.
    """
    parts = _parts(df, url)
    return _rated(parts, parts, "ua < ub").filter(F.col("similarity") >= threshold)


def _links(df: DataFrame, url: str, threshold: float) -> DataFrame:
    """``(a, b)``: links that connect the same URLs as all pairs of ``similar_urls`` do.

    URLs of one strict form are linked to the first of them.  URLs of one host and path are rated alike against
    any other, so one of them stands for all and is linked to the others.  Up to 0.9 any two URLs of a host are similar: they are linked to its first, and only pairs across
    hosts are compared.
    """
    parts = _parts(df, url).withColumns({"h": F.col("p.full_domain"), "path": F.col("p.path")})
    strict = parts.join(parts.groupBy("n").agg(F.min("u").alias("a")), "n").select("a", F.col("u").alias("b"))
    alike = cut(parts.groupBy("h", "path", "g").agg(F.min(F.struct("u", "n", "p", "block")).alias("x")).select("h", "path", "g", "x.*"))
    same = parts.join(alike.select("h", "path", "g", F.col("u").alias("a")), ["h", "path", "g"]).select("a", F.col("u").alias("b"))
    links = strict.unionByName(same)
    if threshold > 0.9:
        return links.unionByName(_rated(alike, alike, "ua < ub").filter(F.col("similarity") >= threshold).select("a", "b"))
    star = alike.filter("h <> ''").join(alike.groupBy("h").agg(F.min("u").alias("a")), "h").select("a", F.col("u").alias("b"))
    across = _rated(alike, alike, "ua < ub and pa.full_domain <> pb.full_domain").filter(F.col("similarity") >= threshold)
    return links.unionByName(star).unionByName(across.select("a", "b"))


def cross_host_clusters(df: DataFrame, url: str, threshold: float = 0.85) -> DataFrame:
    """``(url, canonical)`` for every distinct URL: connected by similarity, the smallest URL canonical.

    Null URLs are left out; URLs without a partner are their own cluster.
    """
    distinct = df.select(F.col(url).alias("url")).filter("url is not null").distinct()
    found = components(_links(df, url, threshold))
    return distinct.join(found, distinct["url"] == found["node"], "left").select("url", F.coalesce("component", "url").alias("canonical"))
