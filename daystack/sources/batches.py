"""What a batch service returns: results, errors, listings, usage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from daystack.functions.payload import response_text
from daystack.schemas import BATCH_STATUS, RESULT_LINE


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Lines of result files, blank ones skipped: batch line, custom_id and the response's text."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.col("value").alias("line"), F.from_json("value", RESULT_LINE)["custom_id"].alias("custom_id"), response_text(F.col("value")).alias("text"))


def all_errors(inline: DataFrame, from_file: DataFrame) -> DataFrame:
    """Errors that came with the status and those of the error file."""
    return inline.unionByName(from_file, allowMissingColumns=True)


def unanswered(asked: DataFrame, results: DataFrame, key: str = "article_id") -> DataFrame:
    """Ids of finished batches for which no result came: the service loses some without a word."""
    return asked.join(results.select(key).distinct(), key, "left_anti")


class PagedBatches(DataSource):
    """A service's listing as a table: spark.read.format("paged_batches").option(...).

    ``client`` names an importable function ("module:function") that takes (after, limit) and returns
    (rows, has_more); pages follow each other by the last row's id, up to ``max_pages`` of ``page_size``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_batches"

    def schema(self) -> str:
        return BATCH_STATUS

    def reader(self, schema) -> DataSourceReader:
        return _Pages(self.options)


class _Pages(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import importlib

        module, _, function = self.options["client"].partition(":")
        fetch = getattr(importlib.import_module(module), function)
        size, pages = int(self.options.get("page_size", 100)), int(self.options.get("max_pages", 100))
        names = [c.split()[0] for c in BATCH_STATUS.split(", ")]
        after = None
        for _ in range(pages):
            rows, more = fetch(after, size)
            for r in rows:
                yield tuple(r.get(n) for n in names)
            if not rows or not more:
                return
            after = rows[-1]["batch_id"]


def list_batches(spark: SparkSession, client: str, status: str | None = None, page_size: int = 100, max_pages: int = 100) -> DataFrame:
    """The listing, filtered by status after it was cut to ``max_pages``."""
    spark.dataSource.register(PagedBatches)
    rows = spark.read.format("paged_batches").options(client=client, page_size=page_size, max_pages=max_pages).load()
    return rows if status is None else rows.where(F.col("status") == status)
