"""Rates over time: sliding windows, admission, running balances.

Windows over all rows in time order would put them in one task.  Here rows are dealt by stretches of
time; what a stretch needs of others is the sums of the times just before it, or one number.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def sliding_sum(rows: DataFrame, ts: str, tokens: str, window_seconds: int, name: str = "current") -> DataFrame:
    """``rows`` with the sum of ``tokens`` (whole numbers) over the window up to each row's time; a row exactly as old as the window is out.

    A window's sum is what has come less what has left, so each time costs the same however many rows
    its window holds.  Rows combine by time where they are read.  A time's sum enters its stretch of one window's
    length; the next stretch has it from the start, and takes it away once it is as old as the window.
    """
    w = window_seconds * 1_000_000
    at = rows.withColumn("_us", _micros(ts))
    n, k = F.col("_n"), F.col("_k")
    times = at.groupBy("_us").agg(F.sum(tokens).alias("_n"), F.count(tokens).alias("_k"))
    times = times.withColumn("_n", F.coalesce("_n", F.lit(0))).withColumn("_s", F.col("_us") - F.pmod("_us", F.lit(w)))
    step = lambda s, us, sign, own: F.struct(s.alias("s"), us.alias("us"), (n * sign).alias("n"), (k * sign).alias("k"), F.lit(own).alias("own"))
    s, us = F.col("_s"), F.col("_us")
    steps = F.array(step(s, us, 1, True), step(s + w, s + w, 1, False), step(s + w, us + w, -1, False))
    each = times.select(F.explode(F.when(us.isNull(), F.slice(steps, 1, 1)).otherwise(steps)).alias("e")).select("e.*")
    each = each.groupBy("s", "us").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max("own").alias("own"))
    so_far = Window.partitionBy("s").orderBy("us").rowsBetween(Window.unboundedPreceding, 0)
    sums = each.select(F.col("us").alias("_at"), "own", F.when(F.sum("k").over(so_far) > 0, F.sum("n").over(so_far)).alias(name)).where("own").drop("own")
    return at.join(sums, F.col("_us").eqNullSafe(F.col("_at")), "left").drop("_us", "_at")


def admission(rows: DataFrame, tokens: str, limit: int, pace: float, current: str = "current") -> DataFrame:
    """Whether a row would have been let in, given the sum that has it already."""
    return rows.withColumn("admitted", F.col(current) <= F.lit(limit * pace))


def running_balance(rows: DataFrame, ts: str, seq: str, delta: str, stretch_seconds: int = 86_400) -> DataFrame:
    """``rows`` with balance: the running sum of ``delta``, never below 0.

    With a floor of 0 the balance is the plain sum less its least value so far, where that is below 0.
    Stretches' sums and least values are one row each; only these are looked at in order.
    """
    at = rows.withColumn("_s", F.floor(_micros(ts) / (stretch_seconds * 1_000_000)))
    inside = Window.partitionBy("_s").orderBy(ts, seq).rowsBetween(Window.unboundedPreceding, 0)
    at = at.withColumn("_sum", F.sum(delta).over(inside)).withColumn("_low", F.min("_sum").over(inside))
    each = at.groupBy("_s").agg(F.sum(delta).alias("_total"), F.min("_sum").alias("_least"))
    before = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    each = each.withColumn("_past", F.coalesce(F.min(F.col("_base") + F.col("_least")).over(before), F.lit(0))).select("_s", "_base", "_past")
    out = at.join(each, "_s")
    total = F.col("_base") + F.col("_sum")
    low = F.least(F.col("_past"), F.col("_base") + F.col("_low"), F.lit(0))
    return out.withColumn("balance", total - low).drop("_s", "_sum", "_low", "_base", "_past")


def total_usage(buckets: DataFrame) -> DataFrame:
    """The sum of input_tokens over nested usage buckets, 0 where there are none."""
    each = buckets.select(F.explode("results").alias("r"))
    return each.agg(F.coalesce(F.sum(F.coalesce("r.input_tokens", F.lit(0))), F.lit(0)).alias("input_tokens"))


@dataclass
class RateTracker:
    """A driver's own pacing: consumption in a sliding window, by a clock that tests can replace."""

    limit: int
    pace: float = 0.75
    window: int = 60
    step: int = 5
    patience: int = 300
    used: list[tuple[float, int]] = field(default_factory=list)

    def current(self, now: float) -> int:
        self.used = [(t, n) for t, n in self.used if t > now - self.window]
        return sum(n for _, n in self.used)

    def admits(self, tokens: int, now: float) -> bool:
        return self.current(now) + tokens <= self.limit * self.pace

    def wait(self, tokens: int, clock, sleep) -> float:
        """Seconds waited until the tokens were let in, and recorded; TimeoutError after ``patience``."""
        waited = 0.0
        while not self.admits(tokens, clock()):
            if waited >= self.patience:
                raise TimeoutError(f"no room for {tokens} tokens within {self.patience} s")
            sleep(self.step)
            waited += self.step
        self.used.append((clock(), tokens))
        return waited


def simulated_waits(requests: Iterable[tuple[float, int]], tracker: RateTracker) -> list[float]:
    """Waits of a sequence of (arrival, tokens) on a virtual clock."""
    now, out = 0.0, []

    def sleep(seconds: float) -> None:
        nonlocal now
        now += seconds

    for arrival, tokens in requests:
        now = max(now, arrival)
        out.append(tracker.wait(tokens, lambda: now, sleep))
    return out
