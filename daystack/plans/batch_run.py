"""The batch mode: requests go to a service in batches cut by tokens, within its limits.

The driver schedules; it holds one batch's lines at a time, and of each batch a few numbers.  Articles,
requests and answers are tables in the shared folder.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystack.config import RunConfig
from daystack.functions.payload import parsed_response, response_text
from daystack.functions.text import classify_prompt, extract_prompt, request_tokens
from daystack.operators.articles import classified, of_kind, only, with_article
from daystack.operators.batching import batch_totals, requests_jsonl, token_batches
from daystack.operators.daily import validated
from daystack.operators.durable import durable
from daystack.operators.lifecycle import TERMINAL, Queues
from daystack.operators.rates import RateTracker
from daystack.plans.pipeline import Run
from daystack.providers.base import BatchClient
from daystack.providers.service import stated_limit, submit

log = logging.getLogger(__name__)


@dataclass
class Batch:
    """What the driver knows of a batch."""

    kind: str
    path: str
    number: int
    tokens: int
    batch_id: str | None = None
    started: float = 0.0
    changed: float = 0.0
    processed: int | None = None
    stalls: int = 0


@dataclass
class BatchRunner:
    client: BatchClient
    config: RunConfig = field(default_factory=RunConfig)
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    max_stalls: int = 3

    def __post_init__(self) -> None:
        self.queues = Queues(self.config.max_inflight_batches, self.config.max_retries + 1)
        self.tracker = RateTracker(self.config.tpm_limit, self.config.tpm_pace_threshold, self.config.tpm_window_seconds)
        self.enqueued, self.limit = 0, self.config.max_enqueued_tokens
        self.active: list[Batch] = []
        self.failed: list[str] = []  # paths of batches that gave nothing

    # ------------------------------------------------ planning

    def plan(self, spark: SparkSession, articles: DataFrame, kind: str) -> None:
        """Cut the articles' requests into batches, keep their lines, and queue them."""
        c, most = self.config, self.config.max_tokens_per_request
        prompt = classify_prompt(F.col("title"), F.col("content"), most, c.tokenizer) if kind == "classification" else extract_prompt(F.col("content"), most, c.tokenizer)
        items = articles.select("article_id", "seq", prompt.alias("prompt"))
        items = items.withColumn("tokens", request_tokens(F.col("prompt"), c.request_overhead_tokens, c.tokenizer))
        limits = {"classification": {"max_tokens": 2}, "extraction": {"max_tokens": 350, "stop": "```"}}[kind]
        cuts = durable(token_batches(items.select("article_id", "seq", "tokens"), c.max_tokens_per_batch))
        path = f"{self.folder}/{kind}-{uuid.uuid4().hex}"
        lines = requests_jsonl(items, kind, "prompt", **limits).join(cuts.select("article_id", "batch_id"), "article_id")
        lines.repartition("batch_id").write.partitionBy("batch_id").parquet(path)
        for r in batch_totals(cuts).orderBy("batch_id").toLocalIterator():
            self.queues.put(kind, Batch(kind, path, r["batch_id"], r["tokens"]))

    def lines(self, spark: SparkSession, batch: Batch) -> list[str]:
        return [r["line"] for r in spark.read.parquet(batch.path).where(F.col("batch_id") == batch.number).orderBy("article_id").select("line").collect()]

    # ------------------------------------------------ the loop

    def _room(self, tokens: int) -> bool:
        within = self.enqueued + tokens <= self.limit * self.config.enqueued_pace_threshold and self.tracker.admits(tokens, self.clock())
        # a batch over the limits by itself would wait for ever: it goes alone
        return within or not self.active and tokens > min(self.limit * self.config.enqueued_pace_threshold, self.tracker.limit * self.tracker.pace)

    def _submit(self, spark: SparkSession) -> None:
        while found := self.queues.next():
            kind, batch = found
            if not self._room(batch.tokens):
                getattr(self.queues, kind).appendleft(batch)
                return
            try:
                batch.batch_id = submit(self.client, self.lines(spark, batch), self.config.max_retries, self.sleep)
            except Exception as e:
                self.limit = stated_limit(str(e)) or self.limit
                if not self.queues.failed(kind, batch):
                    log.error("batch given up: %s", e)
                    self.failed.append((batch.path, batch.number))
                return
            now = self.clock()
            batch.started = batch.changed = now
            batch.processed = None
            self.enqueued += batch.tokens
            self.tracker.used.append((now, batch.tokens))
            self.queues.submitted(batch.batch_id)
            self.active.append(batch)

    def _end(self, batch: Batch) -> None:
        self.active.remove(batch)
        self.queues.done(batch.batch_id)
        self.enqueued = max(0, self.enqueued - batch.tokens)

    def _poll(self, spark: SparkSession) -> None:
        for batch in list(self.active):
            s, now = self.client.status(batch.batch_id), self.clock()
            if s.get("processed") != batch.processed:
                batch.processed, batch.changed = s.get("processed"), now
            if s["status"] in TERMINAL:
                self._end(batch)
                if s["status"] == "completed":
                    self._keep(spark, batch)
                else:
                    self.failed.append((batch.path, batch.number))
            elif now - batch.started > self.config.per_batch_timeout:
                self.client.cancel(batch.batch_id)
                self._end(batch)
                self.failed.append((batch.path, batch.number))
            elif now - batch.changed > self.config.batch_stall_timeout:
                self.client.cancel(batch.batch_id)
                self._end(batch)
                batch.stalls += 1
                if batch.stalls <= self.max_stalls:
                    self.queues.put(batch.kind, batch)
                else:
                    self.failed.append((batch.path, batch.number))

    def _keep(self, spark: SparkSession, batch: Batch) -> None:
        """A batch's result lines join the table of its kind; true ones are asked about further."""
        lines = [(x,) for x in self.client.results(batch.batch_id) if x.strip()]
        rows = spark.createDataFrame(lines, "line string")
        rows.write.mode("append").parquet(f"{self.folder}/results-{batch.kind}")
        if batch.kind == "classification":
            yes = self._answers(rows, "classification").where("label = 'true'")
            if not yes.isEmpty():
                self.plan(spark, only(self.articles, yes), "extraction")

    @staticmethod
    def _answers(lines: DataFrame, kind: str) -> DataFrame:
        rows = lines.select(F.get_json_object("line", "$.custom_id").alias("custom_id"), response_text(F.col("line")).alias("text"))
        rows = of_kind(rows, kind).dropDuplicates(["article_id"])
        return classified(rows) if kind == "classification" else rows

    def run(self, spark: SparkSession, articles: DataFrame) -> Run:
        """All articles through both kinds of request."""
        durable(spark.range(1))
        self.folder = f"{spark.sparkContext.getCheckpointDir()}/batches-{uuid.uuid4().hex}"
        self.articles = articles = durable(articles)
        self.plan(spark, articles, "classification")
        while self.queues.classification or self.queues.extraction or self.active:
            self._submit(spark)
            self._poll(spark)
            if self.active or self.queues.classification or self.queues.extraction:
                self.sleep(max(10, self.config.poll_interval))
        none = spark.createDataFrame([], "line string")
        read = lambda kind: spark.read.parquet(path) if _exists(spark, path := f"{self.folder}/results-{kind}") else none
        labels = durable(self._answers(read("classification"), "classification").select("article_id", "text", "label"))
        payloads = self._answers(read("extraction"), "extraction").select("article_id", parsed_response(F.col("text"), "extraction").alias("payload"))
        outcomes = durable(validated(with_article(payloads, articles)))
        return Run(articles, labels, outcomes)

    def failed_articles(self, spark: SparkSession) -> DataFrame:
        """Articles of batches that failed, timed out or stood still too often."""
        out = self.articles.limit(0)
        for path, number in self.failed:
            ids = spark.read.parquet(path).where(F.col("batch_id") == number).select("article_id")
            out = out.unionByName(only(self.articles, ids))
        return out.dropDuplicates(["article_id"])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def earlier_rows(spark: SparkSession, state: dict) -> DataFrame:
    """A saved state's daily rows, to compete with those of a new run; they come before all of these."""
    rows = [(d, r["article_id"], r["title"], r["post"], r["data"]["pilgrim_count"], json.dumps(r["data"].get("other_metrics") or {}), k - 10**9) for k, (d, r) in enumerate(sorted(state["darshan_rows"].items()))]
    return spark.createDataFrame(rows, "date string, article_id string, title string, link string, pilgrim_count long, other_metrics string, seq long")
