"""What becomes of batches: terminal states, stalls, timeouts, and which queue goes next."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: States in which the pipeline is done with a batch; the cancelling tool knows one more.
TERMINAL = ("completed", "failed", "expired")
TERMINAL_FOR_CANCEL = (*TERMINAL, "cancelled")
OPEN = ("validating", "in_progress", "finalizing")


def is_terminal(status: Column, states: tuple[str, ...] = TERMINAL) -> Column:
    return status.isin(*states)


def stalls(polls: DataFrame, batch: str, ts: str, seq: str, processed: str, stall_seconds: int) -> DataFrame:
    """``polls`` with last_change and stalled: whether ``processed`` has stood still for more than the limit."""
    by = Window.partitionBy(batch).orderBy(ts, seq)
    before = F.lag(processed).over(by)
    changed = F.when(before.isNull() | (F.col(processed) != before), F.col(ts))
    rows = polls.withColumn("_changed", changed)
    last = F.last("_changed", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("last_change", last).drop("_changed")
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("last_change").cast("timestamp"))
    return rows.withColumn("stalled", seconds > F.lit(stall_seconds * 1_000_000))


def timeouts(polls: DataFrame, batch: str, ts: str, timeout_seconds: int) -> DataFrame:
    """``polls`` with elapsed seconds since the batch's first and whether that is over the limit."""
    first = F.min(ts).over(Window.partitionBy(batch))
    elapsed = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / 1e6
    return polls.withColumn("elapsed", elapsed).withColumn("timed_out", F.col("elapsed") > timeout_seconds)


def decision(status: Column, timed_out: Column, stalled: Column) -> Column:
    """What to do with a polled batch: its end counts first, then the absolute timeout, then a stall."""
    return F.when(is_terminal(status), status).when(timed_out, "timeout").when(stalled, "stalled").otherwise("wait")


def open_batches(batches: DataFrame, max_tokens_per_request: int) -> DataFrame:
    """Batches that are not done, oldest first (no time is the oldest), with what they have enqueued."""
    rows = batches.where(F.col("status").isin(*OPEN))
    return rows.withColumn("estimated_tokens", F.col("total_requests") * max_tokens_per_request).orderBy(F.coalesce("created_at", F.lit(0)), "batch_id")


def cancel_candidates(batches: DataFrame) -> DataFrame:
    """Batches that a cancellation would reach."""
    return batches.where(~is_terminal(F.col("status"), TERMINAL_FOR_CANCEL))


def listed(batches: DataFrame, status: str | None = None, page_size: int = 100, max_pages: int = 100) -> DataFrame:
    """The newest page_size x max_pages batches, of these the ones with the status."""
    rows = batches.orderBy(F.desc("created_at"), "batch_id").limit(page_size * max_pages)
    return rows if status is None else rows.where(F.col("status") == status)


@dataclass
class Queues:
    """Batches waiting for submission: classification before extraction, each first in, first out."""

    max_inflight: int
    max_attempts: int = 3
    classification: deque = field(default_factory=deque)
    extraction: deque = field(default_factory=deque)
    inflight: set = field(default_factory=set)
    attempts: dict = field(default_factory=dict)

    def put(self, kind: str, batch) -> None:
        getattr(self, kind).append(batch)

    def next(self) -> tuple[str, object] | None:
        """The batch to submit now, or None if there is none or no room."""
        if len(self.inflight) >= self.max_inflight:
            return None
        for kind in ("classification", "extraction"):
            if queue := getattr(self, kind):
                return kind, queue.popleft()
        return None

    def submitted(self, batch_id: str) -> None:
        self.inflight.add(batch_id)

    def done(self, batch_id: str) -> None:
        self.inflight.discard(batch_id)

    def failed(self, kind: str, batch) -> bool:
        """Back to the head of its queue, unless it has failed ``max_attempts`` times."""
        n = self.attempts[id(batch)] = self.attempts.get(id(batch), 0) + 1
        if n < self.max_attempts:
            getattr(self, kind).appendleft(batch)
        return n < self.max_attempts
