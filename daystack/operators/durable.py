"""Cuts in the lineage that survive lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder of ``spark.checkpoint.dir``.

    Local sessions without one get a temporary folder; elsewhere its absence is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="daystack-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
