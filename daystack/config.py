"""Parameters of a run, checked when they are made."""

from __future__ import annotations

from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class RunConfig:
    """Limits and paces; names follow the command line's options."""

    batch_size: int = 75  # recorded only: batches are cut by tokens
    max_retries: int = 3
    max_inflight_batches: int = 10
    per_record: bool = False
    max_tokens_per_request: int = 4_096
    max_tokens_per_batch: int = 500_000
    request_overhead_tokens: int = 75
    tpm_limit: int = 2_000_000
    tpm_pace_threshold: float = 0.75
    tpm_window_seconds: int = 60
    per_batch_timeout: int = 86_400
    batch_stall_timeout: int = 3_900
    max_enqueued_tokens: int = 2_000_000
    enqueued_pace_threshold: float = 0.90
    requests_per_day: int = 10_000
    poll_interval: int = 10
    rate_wait_step: int = 5
    rate_wait_limit: int = 300
    period_from: str = "filename"
    tokenizer: str = ""  # a JSON file, or tiktoken:model; four characters a token without one

    def __post_init__(self) -> None:
        if not 1 <= self.batch_size <= 10_000:
            raise ValueError("batch_size must be from 1 to 10000")
        for name in ("max_inflight_batches", "max_tokens_per_request", "max_tokens_per_batch", "tpm_limit", "per_batch_timeout", "batch_stall_timeout", "max_enqueued_tokens", "requests_per_day", "tpm_window_seconds"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.max_retries < 0:
            raise ValueError("max_retries must not be negative")
        for name in ("tpm_pace_threshold", "enqueued_pace_threshold"):
            if not 0 < getattr(self, name) <= 1:
                raise ValueError(f"{name} must be over 0 and at most 1")
        if self.period_from not in ("filename", "row"):
            raise ValueError("period_from is filename or row")

    def as_dict(self) -> dict:
        return asdict(self)
