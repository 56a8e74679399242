"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The table written once to the reliable checkpoint folder and read from there.

    The folder is the one the session names in ``spark.checkpoint.dir``; only where that is unset and the
    session runs inside one process (tests) a temporary folder is set.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        where = context.getConf().get("spark.checkpoint.dir")
        if where is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="resinv-checkpoint-")
        context.setCheckpointDir(where)
    return df.checkpoint(eager=True)
