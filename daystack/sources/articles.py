"""Article files: a directory of CSVs, rows to retry, and row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystack.operators.articles import cleaned
from daystack.schemas import ARTICLE_COLUMNS


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, by the header; quotes double inside quotes, fields may span lines."""
    rows = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("pathGlobFilter", "*.csv").csv(path)
    for c in ARTICLE_COLUMNS:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    return rows


def _placed(rows: DataFrame, rank: int) -> DataFrame:
    """Where each row came from.  A file of quoted lines is read by one task, so ids ascend within it."""
    return rows.select(*[c for c in ARTICLE_COLUMNS if c != "page"], F.lit(rank == 0).alias("retry"), F.lit(rank).alias("source_rank"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"), F.monotonically_increasing_id().alias("row_seq"))


def read_articles(spark: SparkSession, directory: str, period_from: str = "filename") -> DataFrame:
    """Cleaned articles of a directory's *.csv, in the order of paths and rows.

    Year and month come from names like articles_<year>_<month>.csv, where files with fewer parts are
    skipped, or from the rows.
    """
    rows = _placed(read_csv(spark, directory), 1)
    if period_from == "filename":
        parts = F.split(F.regexp_replace("file_name", "\\.csv$", ""), "_")
        rows = rows.withColumn("_parts", parts).where(F.size("_parts") >= 3)
        rows = rows.withColumn("year", F.element_at("_parts", 2)).withColumn("month", F.element_at("_parts", 3)).drop("_parts")
    return cleaned(rows.drop("file_name"))


def read_retry(spark: SparkSession, path: str) -> DataFrame:
    """Rows that failed before, with their own year and month; rows without either are skipped."""
    rows = _placed(read_csv(spark, path), 0).drop("file_name")
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return cleaned(rows.where(has("year") & has("month")))


def count_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path).agg(F.count("*").alias("rows"))
