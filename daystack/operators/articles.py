"""Loading rules for articles: cleaning, filtering, first-wins deduplication, lookups by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daystack.functions.text import article_of, composite_key, id_matches, label, strip


def cleaned(rows: DataFrame, columns: tuple[str, ...] = ("article_id", "title", "content", "link")) -> DataFrame:
    """Stripped columns, null as empty; rows without an id or content go."""
    for c in columns:
        rows = rows.withColumn(c, strip(c))
    return rows.where((F.col("article_id") != "") & (F.col("content") != ""))


def with_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", composite_key(F.col("year"), F.col("month"), F.col("article_id")))


def first_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of rows with the same key the first in order.

    By an aggregation, not a window: rows combine where they are read, so a key of any weight costs
    each task one row.
    """
    rest = [c for c in rows.columns if c != key]
    least = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return least.select(*[F.col(c) if c == key else F.col("_first")[c].alias(c) for c in rows.columns])


def retry_then_directory(retry: DataFrame, directory: DataFrame) -> DataFrame:
    """Rows of both, the retried ones first; of equal ids the first is kept."""
    return first_wins(retry.unionByName(directory, allowMissingColumns=True), "article_id", ["source_rank", "file", "row_seq"])


def not_seen(rows: DataFrame, seen: DataFrame, key: str = "article_id") -> DataFrame:
    """Rows whose key is not among those seen."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def only(rows: DataFrame, ids: DataFrame, key: str = "article_id") -> DataFrame:
    """Rows whose key is among the ids: for the next stage, or to be queued again."""
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def with_article(results: DataFrame, articles: DataFrame, key: str = "article_id") -> DataFrame:
    """Results with their article's columns; results for unknown ids are dropped."""
    return results.join(articles, key)


def classification_items(articles: DataFrame) -> DataFrame:
    return articles.select("article_id", "title", "content")


def extraction_items(articles: DataFrame) -> DataFrame:
    return articles.select("article_id", "content")


def classified(responses: DataFrame, text: str = "text") -> DataFrame:
    """Each response's label: true, false, or null for a failure."""
    return responses.withColumn("label", label(F.col(text)))


def of_kind(results: DataFrame, kind: str) -> DataFrame:
    """Results with this kind's request ids, and their article ids; others are ignored."""
    c = F.col("custom_id")
    return results.where(id_matches(c, kind)).withColumn("article_id", article_of(c, kind))


def batch_articles(batches: DataFrame) -> DataFrame:
    """A row for each article of each batch."""
    return batches.select("batch_id", F.explode("article_ids").alias("article_id"))


def once(rows: DataFrame, key: str = "batch_id") -> DataFrame:
    """One effect for each batch, however often it is reported."""
    return rows.dropDuplicates([key])


def counters(articles: DataFrame, labels: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row of a run's counters and the success rate.

    ``labels`` has label, ``outcomes`` has outcome and date (of valid ones).
    """
    a = articles.agg(F.count("*").alias("total_loaded"))
    b = labels.agg(F.count_if(F.col("label") == "true").alias("classified_true"), F.count_if(F.col("label") == "false").alias("classified_false"))
    good = F.col("outcome") == "extracted_success"
    c = outcomes.agg(
        F.count_if(good).alias("extracted_success"),
        F.count_if(F.col("outcome") == "extracted_failed").alias("extracted_failed"),
        F.count_if(F.col("outcome") == "invalid_date").alias("invalid_date"),
        F.count_distinct(F.when(good, F.col("date"))).alias("final_records"),
    )
    return a.crossJoin(b).crossJoin(c).withColumn("success_rate", F.try_divide(F.col("extracted_success") * 100.0, F.col("total_loaded")))  # one row each
