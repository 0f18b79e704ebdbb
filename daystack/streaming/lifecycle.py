"""Streaming: polls of batches, token rates, and articles, each with bounded state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daystack.operators.lifecycle import TERMINAL

POLLS = "batch_id string, ts timestamp, status string, processed bigint"
EVENTS = "batch_id string, at timestamp, event string, processed bigint"
STATE = "first bigint, changed bigint, processed bigint, done boolean"


def batch_events(polls: DataFrame, stall_seconds: int, timeout_seconds: int, delay: str = "1 minute") -> DataFrame:
    """completed, failed, expired, timeout or stalled, once for each batch, from a stream of polls.

    State is four numbers a batch.  A batch without polls is given up by event time once the watermark
    has passed its stall or timeout limit.  An end counts before a timeout, and that before a stall.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, changed, processed, done = state.get if state.exists else (None, None, None, False)

        def event(at_ms: int, name: str) -> pd.DataFrame:
            return pd.DataFrame({"batch_id": [key[0]], "at": [pd.Timestamp(at_ms, unit="ms")], "event": [name], "processed": [processed]})

        if state.hasTimedOut:
            # kept until the limits are out of reach of late polls, then forgotten
            if not done:
                now = state.getCurrentWatermarkMs()
                yield event(now, "timeout" if now - first > 1000 * timeout_seconds else "stalled")
            state.remove()
            return
        rows = pd.concat(list(frames)).sort_values("ts", kind="stable")
        for ts, status, n in zip(rows["ts"], rows["status"], rows["processed"], strict=True):
            now = int(ts.timestamp() * 1000)
            first = now if first is None else first
            if processed is None or n != processed:
                changed, processed = now, int(n)
            if done:
                continue
            name = status if status in TERMINAL else "timeout" if now - first > 1000 * timeout_seconds else "stalled" if now - changed > 1000 * stall_seconds else None
            if name:
                done = True
                yield event(now, name)
        state.update((first, changed, processed, done))
        limit = min(first + 1000 * timeout_seconds, changed + 1000 * stall_seconds) + 1
        state.setTimeoutTimestamp(max(limit, state.getCurrentWatermarkMs() + 1))

    return polls.withWatermark("ts", delay).groupBy("batch_id").applyInPandasWithState(step, EVENTS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def token_rates(requests: DataFrame, window: str = "60 seconds", slide: str = "10 seconds", delay: str = "1 minute") -> DataFrame:
    """Tokens in sliding windows over a stream of (ts, tokens)."""
    by = F.window("ts", window, slide)
    return requests.withWatermark("ts", delay).groupBy(by).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("requests")).select("window.start", "window.end", "tokens", "requests")


def first_articles(articles: DataFrame, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Of articles with one id the first that comes; ids are remembered for ``delay``."""
    return articles.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["article_id"])


def into_daily_table(valid: DataFrame, path: str, checkpoint: str):
    """Keep a table of each day's best row up to date with a stream of valid rows (date, pilgrim_count, seq).

    Each micro-batch is merged with the table as it was and written beside it under the batch's number;
    a batch that is run again after a failure reads the same predecessor and writes the same rows.
    """
    from daystack.operators.daily import daily_best

    def merge(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        earlier = f"{path}/batch={number - 1}"
        if number > 0:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(earlier))
        daily_best(rows).select(*rows.columns).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return valid.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
