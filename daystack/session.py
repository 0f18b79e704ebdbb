"""Session construction for local runs, tests and the benchmark."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that every entry point relies on.  A cluster session keeps its own values for the rest.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session with ``cores`` threads; ``conf`` overrides single settings."""
    settings = REQUIRED | {
        "spark.sql.shuffle.partitions": str(partitions or cores),
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return SparkSession.builder.master(f"local[{cores}]").appName("daystack").config(map=settings).getOrCreate()


def share(spark: SparkSession) -> SparkSession:
    """Put this package on the Python path of the workers, for where it is not installed on them."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    have = environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)
    return spark
