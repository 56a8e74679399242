"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

The size of a document is its number of tokens of a public tokenizer.  The size of the mixture is the largest
at which every source can hold its share with none of its documents used more than its cap.  The mixture is a
number of shards of equal size; the tokens of a shard are cut into equal blocks, and the blocks go to the
sources by highest quotients (share / 1, share / 3, share / 5 ...), which gives integer quotas per shard that
are as near to the shares as blocks can be.  A source fills its quota of every shard from its documents in
seeded order, its whole stock before any document a second time, and so on up to the cap.

Scale: documents are never collected - per source the sum of tokens, and positions within a source by a running
sum over hash ranges, of which one number per source and range is added up.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from resinv.operators.lineage import cut

TOKENIZERS = "/opt/tokenizers"
RANGE_SIZE = 200_000

_encoders: dict[str, object] = {}


def _encoder(path: str, pattern: str):
    """A tiktoken encoding read once per worker."""
    if path not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


#: Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counts(documents: DataFrame, text_col: str, tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """The table without its text, with ``tokens``; null and empty texts have none.  Texts are read whole."""
    others = [c for c in documents.columns if c != text_col]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer, PATTERN)
        for pdf in batches:
            out = pdf[others].copy()
            out["tokens"] = [len(encoder.encode_ordinary(t)) if t else 0 for t in pdf[text_col].where(pdf[text_col].notna(), "")]
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name != text_col)
    return documents.mapInPandas(count, f"{schema}, tokens long")


def apportion(shares: dict[str, float], seats: int) -> dict[str, int]:
    """Sainte-Lague: seats by highest quotients share / (2 s + 1); ties go to the smaller name."""
    total = sum(v for v in shares.values() if v > 0)
    if total <= 0:
        return dict.fromkeys(shares, 0)
    won = dict.fromkeys(shares, 0)
    heap = [(-v, k) for k, v in shares.items() if v > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-shares[k] / (2 * won[k] + 1), k))
    return won


def mix(
    documents: DataFrame,
    id_col: str,
    source_col: str,
    tokens_col: str,
    targets: DataFrame,
    shards: int = 8,
    blocks: int = 2000,
    seed: int = 17,
    max_sources: int = 10_000,
) -> tuple[DataFrame, DataFrame]:
    """The mixture ``(id, source, shard, times, tokens)`` and the report ``(source, target_share, stock, used,
    share, repeats)``.

    ``targets`` holds (source, target_share, max_repeats).  Documents of other or null sources and documents
    without tokens take no part; a source without documents or with a null or non-positive share gets nothing
    and the others' shares are scaled up; null caps count as 1.  Repeated rows of an id count as one document.
    Empty documents or targets give an empty mixture.
    """
    wanted = targets.select(F.col("source").alias("source"), F.col("target_share").cast("double").alias("share"), F.greatest(F.coalesce(F.col("max_repeats"), F.lit(1)), F.lit(1)).cast("int").alias("cap"))
    goals = wanted.filter("source is not null and share > 0").limit(max_sources + 1).collect()
    if len(goals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    docs = documents.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(tokens_col).cast("long").alias("tokens")).filter("id is not null and source is not null and tokens > 0")
    docs = docs.groupBy("id").agg(F.min(F.struct("source", "tokens")).alias("x")).select("id", "x.*")
    docs = cut(docs.join(F.broadcast(targets.select("source").filter("source is not null").distinct()), "source"))  # as many as goals
    ranges = max(1, -(-docs.count() // RANGE_SIZE))
    docs = docs.withColumn("h", F.xxhash64(F.lit(seed), "id")).withColumn("range", F.pmod(F.shiftrightunsigned("h", 32), F.lit(ranges)).cast("int"))
    per = docs.groupBy("source", "range").agg(F.sum("tokens").alias("size"))
    sizes = per.groupBy("source").agg(F.sum("size").alias("stock")).collect()
    stock = {r.source: r.stock for r in sizes}
    share = {g.source: g.share for g in goals if stock.get(g.source)}
    cap = {g.source: g.cap for g in goals}
    total = sum(share.values())
    # the largest mixture in which every source holds its share within its cap
    largest = min((stock[s] * cap[s] * total / share[s] for s in share), default=0.0)
    block = max(1, int(largest / (blocks * shards)))
    quota = apportion(share, blocks)
    spark = documents.sparkSession
    plan = [(s, share[s] / total, stock[s], quota[s], cap[s]) for s in share]
    plan_df = spark.createDataFrame(plan, "source string, target double, stock long, quota int, cap int")
    # a shard takes as many blocks in a row as its quota; a seed draws which run goes to which shard
    runs = plan_df.filter("quota > 0").select("source", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("run"))
    drawn = F.row_number().over(Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "run"), "run")) - 1
    chosen = runs.select("source", F.col("run").cast("long").alias("run"), drawn.cast("int").alias("shard"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("source", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "range").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.withColumn("upto", F.sum("tokens").over(inside)).join(starts, ["source", "range"]).join(F.broadcast(plan_df), "source")
    middle = F.col("before") + F.col("upto") - F.col("tokens") / 2.0
    uses = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("cap") - 1))).withColumn("block", F.floor((F.col("pass") * F.col("stock") + middle) / block))
    uses = uses.filter("quota > 0").withColumn("run", F.floor(F.col("block") / F.col("quota"))).join(F.broadcast(chosen), ["source", "run"])  # shards rows a source
    mixture = uses.groupBy("id", "source", "shard", "tokens").agg(F.count("*").cast("int").alias("times"))
    used = mixture.groupBy("source").agg(F.sum(F.col("tokens") * F.col("times")).alias("used"))
    most = mixture.groupBy("source", "id").agg(F.sum("times").alias("t")).groupBy("source").agg(F.max("t").cast("int").alias("repeats"))
    all_used = used.agg(F.sum("used")).scalar()
    report = wanted.join(used, "source", "left").join(most, "source", "left").join(F.broadcast(plan_df.select("source", "stock")), "source", "left")
    report = report.select(
        "source", F.col("share").alias("target_share"), F.coalesce("stock", F.lit(0)).cast("long").alias("stock"), F.coalesce("used", F.lit(0)).cast("long").alias("used"),
        F.coalesce(F.col("used") / all_used, F.lit(0.0)).alias("share"), F.coalesce("repeats", F.lit(0)).alias("repeats"),
    )
    return mixture.select("id", "source", "shard", "times", "tokens"), report
