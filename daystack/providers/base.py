"""What classifies articles and extracts metrics; services for batches; how to choose one."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame


class Provider(Protocol):
    """Both methods get whole texts, and may be called again for a row after a lost task."""

    def classify(self, title: str, content: str) -> str | None: ...

    def extract(self, content: str) -> str | None: ...


class BatchClient(Protocol):
    """A service that works on batches of request lines."""

    def submit(self, lines: list[str]) -> str: ...

    def status(self, batch_id: str) -> dict: ...

    def results(self, batch_id: str) -> list[str]: ...

    def errors(self, batch_id: str) -> list[dict]: ...

    def cancel(self, batch_id: str) -> bool: ...

    def list(self, after: str | None, limit: int) -> tuple[list[dict], bool]: ...


#: Patterns that Java, RE2 and Python read alike.
COUNT_PATTERNS = (r"(?i)([0-9]{1,3}(?:,[0-9]{3})+)\s+pilgrims", r"(?i)pilgrims (?:who )?had darshan[^:]*::?\s*([0-9][0-9,]*)")
DAY_PATTERNS = (r"\b([0-9]{1,2})[.-][0-9]{1,2}[.-][0-9]{4}\b", r"(?i)\b(?:january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec)\.?\s+([0-9]{1,2})\b")


def _first(patterns: tuple[str, ...], text: str) -> str | None:
    return next((m.group(1) for p in patterns if (m := re.search(p, text))), None)


class RuleProvider:
    """Deterministic and offline: an article is about a day's count if its text has both."""

    def classify(self, title: str, content: str) -> str | None:
        return "true" if _first(COUNT_PATTERNS, content) and _first(DAY_PATTERNS, content) else "false"

    def extract(self, content: str) -> str | None:
        import json

        day, count = _first(DAY_PATTERNS, content), _first(COUNT_PATTERNS, content)
        return json.dumps({"day": int(day) if day else None, "pilgrim_count": count, "other_metrics": {}})


def provider(name: str = "rules") -> Provider:
    """``rules``, or an importable class as module:Class."""
    if name == "rules":
        return RuleProvider()
    import importlib

    module, _, cls = name.partition(":")
    return getattr(importlib.import_module(module), cls)()


def classify(articles: DataFrame, name: str = "rules") -> DataFrame:
    """article_id and the provider's text; each row is asked about once, and errors are answers of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = provider(name)
        for b in batches:
            yield _answers(b, lambda r: p.classify(r["title"], r["content"]))

    return articles.select("article_id", "title", "content").mapInArrow(run, "article_id string, text string, error string")


def extract(articles: DataFrame, name: str = "rules") -> DataFrame:
    """The same for extraction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = provider(name)
        for b in batches:
            yield _answers(b, lambda r: p.extract(r["content"]))

    return articles.select("article_id", "content").mapInArrow(run, "article_id string, text string, error string")


def _answers(b: pa.RecordBatch, ask) -> pa.RecordBatch:
    texts, errors = [], []
    for row in b.to_pylist():
        try:
            texts.append(ask(row))
            errors.append(None)
        except Exception as e:
            texts.append(None)
            errors.append(f"{type(e).__name__}: {e}")
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(errors, pa.string())], ["article_id", "text", "error"])


class FakeBatchClient:
    """In memory, for tests: batches end as soon as they are asked about, answered by a provider."""

    def __init__(self, answers: Provider | None = None) -> None:
        self.answers, self.batches = answers or RuleProvider(), {}

    def submit(self, lines: list[str]) -> str:
        batch_id = f"batch-{len(self.batches) + 1}"
        self.batches[batch_id] = {"lines": lines, "status": "in_progress"}
        return batch_id

    def status(self, batch_id: str) -> dict:
        b = self.batches[batch_id]
        if b["status"] == "in_progress":
            b["status"] = "completed"
        return {"status": b["status"], "processed": len(b["lines"]), "failed": 0}

    def results(self, batch_id: str) -> list[str]:
        import json

        out = []
        for line in self.batches[batch_id]["lines"]:
            r = json.loads(line)
            text = r["body"]["messages"][-1]["content"]
            said = self.answers.extract(text) if r["custom_id"].endswith("-extraction") else self.answers.classify("", text)
            out.append(json.dumps({"custom_id": r["custom_id"], "response": {"body": {"choices": [{"message": {"content": said}}]}}}))
        return out

    def errors(self, batch_id: str) -> list[dict]:
        return []

    def cancel(self, batch_id: str) -> bool:
        """True also for a batch that has ended."""
        if batch_id not in self.batches:
            return False
        if self.batches[batch_id]["status"] == "in_progress":
            self.batches[batch_id]["status"] = "cancelled"
        return True

    def list(self, after: str | None, limit: int) -> tuple[list[dict], bool]:
        ids = list(self.batches)
        at = ids.index(after) + 1 if after else 0
        part = ids[at : at + limit]
        return [{"batch_id": i, "status": self.batches[i]["status"], "total_requests": len(self.batches[i]["lines"])} for i in part], at + limit < len(ids)
