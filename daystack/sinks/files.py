"""What a run leaves: series, displaced rows, failures, metadata, state, requests."""

from __future__ import annotations

import json
import logging
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystack.functions.pacing import epoch_text

log = logging.getLogger(__name__)


def _dump(value, path: str) -> None:
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False), encoding="utf-8")


def write_series(series: DataFrame, path: str) -> None:
    """date -> record as one JSON object; a series has a row a day, so the driver can hold it."""
    rows = series.select("date", "article_id", "title", "post", "pilgrim_count", "other_metrics").orderBy("date").toLocalIterator()
    _dump({r["date"]: {"article_id": r["article_id"], "title": r["title"], "post": r["post"], "data": {"pilgrim_count": r["pilgrim_count"], "other_metrics": json.loads(r["other_metrics"] or "{}")}} for r in rows}, path)


def write_displaced(rows: DataFrame, path: str) -> None:
    """date -> list of displaced rows, in the order in which they gave way, as one JSON object.

    Rows (date, displaced_at, seq and what is written) come one by one, so no list is held anywhere.
    """
    hidden = ("date", "displaced_at", "seq")
    date = None
    with Path(path).open("w", encoding="utf-8") as out:
        out.write("{")
        for r in rows.orderBy(*hidden).toLocalIterator():
            line = json.dumps({k: v for k, v in r.asDict().items() if k not in hidden}, ensure_ascii=False)
            if r["date"] != date:
                out.write(("" if date is None else "\n  ],") + f"\n  {json.dumps(r['date'])}: [\n    {line}")
                date = r["date"]
            else:
                out.write(f",\n    {line}")
        out.write("\n}\n" if date is None else "\n  ]\n}\n")


def write_failed(rows: DataFrame, folder: str, label: str) -> str | None:
    """Failed rows as CSV with the articles' own columns; nothing is written when there are none."""
    if rows.isEmpty():
        return None
    path = f"{folder}/failed_records_{label}"
    rows.write.option("header", True).option("quote", '"').option("escape", '"').mode("overwrite").csv(path)
    return path


def write_metadata(path: str, label: str, started: datetime, ended: datetime, provider: str, parameters: dict, before: dict, after: dict, files: dict) -> None:
    _dump({"label": label, "start": started.isoformat(), "end": ended.isoformat(), "elapsed_seconds": (ended - started).total_seconds(), "provider": provider, "parameters": parameters, "initial_metrics": before, "final_metrics": after, "files": files}, path)


def save_state(path: str, state: dict) -> bool:
    """The whole state anew, by way of a second file so that a broken write leaves the old one; errors are logged."""
    try:
        _dump(state, f"{path}.new")
        Path(f"{path}.new").replace(path)
        return True
    except OSError as e:
        log.error("state not saved: %s", e)
        return False


def write_requests(lines: DataFrame, folder: str, batch: str = "batch_id") -> None:
    """Request lines as text, one folder a batch."""
    lines.select(batch, F.col("line").alias("value")).write.partitionBy(batch).mode("overwrite").text(folder)


def batch_table(batches: DataFrame) -> DataFrame:
    """Fixed-width lines of batches for a terminal."""
    dash = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    return batches.select(F.concat_ws("  ", F.rpad(dash("batch_id"), 36, " "), F.rpad(dash("status"), 12, " "), F.rpad(epoch_text(F.col("created_at")), 20, " "), F.rpad(dash("processed"), 8, " "), dash("total_requests")).alias("line"))


def report(counters: dict, seconds: int, displaced: int, dates: int, failed: int) -> list[str]:
    """Lines for the log at the end of a run."""
    h, rest = divmod(seconds, 3600)
    m, s = divmod(rest, 60)
    took = f"{h}h {m}m {s}s" if h else f"{m}m {s}s" if m else f"{s}s"
    lines = [f"duration: {took}", *[f"{k}: {v}" for k, v in counters.items() if k != "success_rate"], f"displaced: {displaced} on {dates} dates", f"failed: {failed}"]
    if counters.get("total_loaded"):
        lines.append(f"success rate: {100 * counters['extracted_success'] / counters['total_loaded']:.1f}%")
    return lines
