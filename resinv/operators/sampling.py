"""Seeded samples and splits that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_hash(seed: int, *columns: str) -> Column:
    """32 bits of a hash of the columns' texts, the same in any engine; null counts as ''."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def sample_n(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n rows in the order of a seeded hash of the whole row; all rows if there are fewer."""
    return df.orderBy(seeded_hash(seed, *df.columns), *[F.col(c).cast("string") for c in df.columns]).limit(n)


def split(df: DataFrame, key: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """With ``part``: each key falls into one named part with the given shares, by a seeded hash.

    Rows of one key share their part; null keys form one key; shares need not add up to one.
    """
    total = sum(shares.values())
    at = F.pmod(seeded_hash(seed, key), F.lit(1_000_000)) / 1_000_000.0
    bound, out = 0.0, F.when(F.lit(False), "")
    names = list(shares)
    for name in names[:-1]:
        bound += shares[name] / total
        out = out.when(at < round(bound, 12), name)
    return df.withColumn("part", out.otherwise(names[-1]))
