"""Submitting batches to a service, with retries for what passes."""

from __future__ import annotations

import logging
import random
import re
from collections.abc import Callable

from daystack.providers.base import BatchClient

log = logging.getLogger(__name__)

TRANSIENT_ERRNO = (11, 104, 110)


def is_transient(error: BaseException) -> bool:
    """Throttled, a server's fault, a timeout, or a connection that is busy, reset or timed out."""
    status = getattr(error, "status_code", None) or getattr(error, "http_status", None)
    return status == 429 or (status is not None and 500 <= status < 600) or isinstance(error, TimeoutError) or getattr(error, "errno", None) in TRANSIENT_ERRNO


def backoff(attempt: int, rng: random.Random) -> float:
    return 5.0 * 2 ** (attempt - 1) + rng.uniform(0, 3)


def submit(client: BatchClient, lines: list[str], retries: int, sleep: Callable[[float], None], rng: random.Random | None = None) -> str:
    """The batch's id; transient errors are tried again up to ``retries`` times, others are raised at once."""
    rng = rng or random.Random()
    for attempt in range(1, retries + 2):
        try:
            return client.submit(lines)
        except Exception as e:
            if attempt > retries or not is_transient(e):
                raise
            log.warning("submission failed, attempt %d: %s", attempt, e)
            sleep(backoff(attempt, rng))
    raise AssertionError


def stated_limit(message: str) -> int | None:
    """The enqueued-token limit that an error message states."""
    m = re.search(r"Limit:\s*([\d,]+)\s+enqueued", message)
    n = int(m.group(1).replace(",", "")) if m and m.group(1).strip(",") else 0
    return n or None
