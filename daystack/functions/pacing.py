"""Delays and backoffs, without jitter unless asked for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RETRY_BASE, RETRY_CAP, RETRY_FLOOR = 5, 60, 1
JITTER = 0.1


def jittered(delay: Column, seed: int | None) -> Column:
    """Up to a tenth more or less; as it is without a seed."""
    return delay if seed is None else delay * (1 + (F.rand(seed) * 2 - 1) * JITTER)


def retry_delay(attempt: Column, retry_after: Column | None = None, seed: int | None = None) -> Column:
    """What the server asked for, or 5 seconds doubling with each attempt; from 1 to 60."""
    own = F.lit(float(RETRY_BASE)) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempt - 1))
    asked = own if retry_after is None else F.coalesce(retry_after.try_cast("double"), own)
    return F.greatest(F.lit(float(RETRY_FLOOR)), F.least(F.lit(float(RETRY_CAP)), jittered(F.least(F.lit(float(RETRY_CAP)), asked), seed)))


def submit_backoff(attempt: Column, seed: int | None = None) -> Column:
    """5 seconds doubling with each attempt, and up to 3 more."""
    own = F.lit(float(RETRY_BASE)) * F.pow(F.lit(2.0), attempt - 1)
    return own if seed is None else own + F.rand(seed) * 3


def is_retryable(status: Column, error: Column, errno: Column) -> Column:
    """Throttled, a server's fault, a timeout, or a connection that is busy, reset or timed out."""
    return F.coalesce((status == 429) | status.between(500, 599), F.lit(False)) | F.coalesce(error == "TimeoutError", F.lit(False)) | F.coalesce(errno.isin(11, 104, 110), F.lit(False))


def day_pacing(made: Column, limit: Column) -> Column:
    """Seconds to wait before the next request of the day, by the share of the limit that is used."""
    ratio = made / limit
    slow = 10 * (1 + 4 * (ratio - 0.9) / 0.1)
    return F.when(ratio >= 0.98, 30.0).when(ratio >= 0.90, slow).otherwise(0.0)


def usage_band(made: Column, limit: Column) -> Column:
    """Per cent of the limit used, to the nearest 5, halves to even."""
    return (F.bround(made * 100.0 / limit / 5) * 5).cast("bigint")


def poll_interval(polls_since_progress: Column, poll: int = 10, most: int = 3600) -> Column:
    """The least interval after progress, doubling with each poll without it."""
    return F.least(F.lit(float(most)), F.lit(float(max(10, poll))) * F.pow(F.lit(2.0), polls_since_progress))


def duration_text(seconds: Column) -> Column:
    """Xh Ym Zs, without leading parts that are 0."""
    s = seconds.cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    text = lambda c: c.cast("bigint").cast("string")
    return F.when(h > 0, F.concat(text(h), F.lit("h "), text(m), F.lit("m "), text(r), F.lit("s"))).when(m > 0, F.concat(text(m), F.lit("m "), text(r), F.lit("s"))).otherwise(F.concat(text(r), F.lit("s")))


def epoch_text(seconds: Column) -> Column:
    """ISO with a Z, or - for null."""
    return F.coalesce(F.concat(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), F.lit("-"))


def run_label(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd_HH-mm-ss-SSSSSS")
