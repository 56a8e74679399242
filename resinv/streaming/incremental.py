"""Stages run incrementally: new files in, results appended, state in the stream's own checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resinv.functions.text import linguistic_score, score_tier

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def run_stage(spark: SparkSession, source: str, schema: T.StructType, stage: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, dedupe: str | None = None) -> None:
    """Runs a batch stage over the files that are new since the last run and appends its rows.

    With ``dedupe`` a key that the target already holds is left out, so a rerun after a failure adds nothing
    twice.
    """

    def write(batch: DataFrame, _: int) -> None:
        out = stage(batch)
        if dedupe:
            out = out.dropDuplicates([dedupe])
            try:
                out = out.join(spark.read.parquet(target).select(dedupe), dedupe, "left_anti")
            except Exception as e:  # noqa: BLE001
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        out.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def score_stage(papers: DataFrame) -> DataFrame:
    """The scoring stage for streams of papers."""
    scored = papers.select("id", *[v.alias(k) for k, v in linguistic_score("title", "abstract").items()])
    return scored.withColumn("tier", score_tier(F.col("ling_score")))


def windowed_counts(events: DataFrame, late: str = "1 hour", length: str = "1 day") -> DataFrame:
    """Counts and sums per type and window; rows later than the watermark are left out by the stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def first_seen(events: DataFrame, key: str, late: str = "1 hour") -> DataFrame:
    """The stream without repeats of a key within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])
