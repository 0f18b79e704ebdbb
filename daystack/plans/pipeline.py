"""The run from articles to the daily series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystack.config import RunConfig
from daystack.functions.payload import parsed_response
from daystack.functions.text import extract_prompt, request_tokens, truncate_tokens
from daystack.operators.articles import classified, counters, only, retry_then_directory, with_article
from daystack.operators.batching import token_batches
from daystack.operators.daily import daily_best, displaced, displaced_lists, validated
from daystack.operators.durable import durable
from daystack.providers import base
from daystack.sources.articles import read_articles, read_retry


@dataclass
class Run:
    """A run's tables.  ``articles``, ``labels`` and ``outcomes`` are kept, so that providers answer once."""

    articles: DataFrame
    labels: DataFrame
    outcomes: DataFrame
    earlier: DataFrame | None = None  # daily rows of a run that this one goes on from

    @property
    def valid(self) -> DataFrame:
        rows = self.outcomes.where(F.col("outcome") == "extracted_success").select("date", "article_id", "title", "link", "pilgrim_count", "other_metrics", "seq")
        return rows if self.earlier is None else self.earlier.unionByName(rows)

    @property
    def series(self) -> DataFrame:
        best = daily_best(self.valid.select("date", "article_id", "title", F.col("link").alias("post"), "pilgrim_count", "other_metrics", "seq"))
        return best.drop("seq")

    @property
    def displaced_rows(self) -> DataFrame:
        return displaced(self.valid.select("date", "article_id", "title", F.col("link").alias("post"), "pilgrim_count", "seq"))

    @property
    def displaced(self) -> DataFrame:
        return displaced_lists(self.displaced_rows, ["article_id", "title", "post", "pilgrim_count"])

    @property
    def failed(self) -> DataFrame:
        """Articles that a provider gave no usable answer for, whatever the stage."""
        bad = self.labels.where("label is null").select("article_id").unionByName(self.outcomes.where("outcome <> 'extracted_success'").select("article_id"))
        return only(self.articles, bad).select("year", "month", "article_id", "title", "link", "content")

    @property
    def counters(self) -> DataFrame:
        return counters(self.articles, self.labels, self.outcomes)


def load(spark: SparkSession, directory: str, config: RunConfig, retry: str | None = None) -> DataFrame:
    """Articles in order, numbered; of equal ids the first, rows to retry before all others.

    Numbers follow (rank, file, row), which is all that later stages ask of them.
    """
    rows = read_articles(spark, directory, config.period_from)
    again = read_retry(spark, retry) if retry else rows.limit(0)
    rows = retry_then_directory(again, rows)
    files = rows.groupBy("source_rank", "file").count()
    from pyspark.sql import Window

    files = files.withColumn("file_no", F.row_number().over(Window.orderBy("source_rank", "file"))).drop("count")  # a row a file
    return rows.join(F.broadcast(files), ["source_rank", "file"]).withColumn("seq", F.col("file_no") * F.lit(1 << 40) + F.col("row_seq") % F.lit(1 << 33)).drop("file_no")


def run(spark: SparkSession, directory: str, config: RunConfig | None = None, provider: str = "rules", retry: str | None = None) -> Run:
    """Load, classify, extract and validate; what goes to a provider is cut to the request's tokens."""
    config = config or RunConfig()
    articles = durable(load(spark, directory, config, retry))
    cut = articles.withColumn("content", truncate_tokens(F.col("content"), config.max_tokens_per_request, config.tokenizer))
    labels = durable(classified(base.classify(cut, provider)))
    asked = only(cut, labels.where("label = 'true'"))
    answers = durable(base.extract(asked, provider))
    payloads = answers.select("article_id", parsed_response(F.col("text"), "extraction").alias("payload"))
    outcomes = durable(validated(with_article(payloads, articles)))
    return Run(articles, labels, outcomes)


def batches(articles: DataFrame, config: RunConfig) -> DataFrame:
    """Articles with the batch of extraction requests that each would go in."""
    tokens = request_tokens(extract_prompt(F.col("content"), config.max_tokens_per_request, config.tokenizer), config.request_overhead_tokens, config.tokenizer)
    return token_batches(articles.select("article_id", "seq", tokens.alias("tokens")), config.max_tokens_per_batch)
