"""A run's saved state, its ledger of batches, and the daily series."""

from __future__ import annotations

import json
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystack.functions.text import calendar_date
from daystack.schemas import LEDGER_ENTRY, SERIES_JSON, STATE_KEYS

log = logging.getLogger(__name__)


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def load_state(spark: SparkSession, path: str) -> dict | None:
    """The state's keys and values; a file that is missing, broken, or has other keys is logged and ignored."""
    try:
        state = json.loads(_text(spark, path))
        if set(state) != set(STATE_KEYS):
            raise ValueError(f"keys are {sorted(state)}")
        return state
    except Exception as e:
        log.error("state %s ignored: %s", path, e)
        return None


def read_ledger(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Pending batches of a state: kind, batch_id, article_ids, estimated_tokens.

    A state is a JSON object over the lines of a file, which is then read whole, or any number of objects
    of one line each, over any number of files, each with some of the batches.  Only a path that does not
    exist has no ledger, which is logged; what cannot be read or parsed is an error, here or when rows are read.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no ledger in %s: %s", path, e)
        rows = spark.createDataFrame([], LEDGER_ENTRY.removeprefix("array<").removesuffix(">"))
        return rows if kind is None else rows.where(F.col("kind") == kind)
    sound = F.json_object_keys("value").isNotNull() & F.col("value").rlike("\\}\\s*$")
    first = lines.where(F.trim("value") != "").select(sound).first()
    if first is None:
        raise ValueError(f"{path} has no state")
    texts = lines.where(F.trim("value") != "") if first[0] else spark.read.text(path, wholetext=True)
    broken = F.raise_error(F.concat(F.lit("no JSON object in "), "_metadata.file_path")).cast(LEDGER_ENTRY)
    entries = F.from_json("value", f"pending_batches {LEDGER_ENTRY}", {"mode": "FAILFAST"})["pending_batches"]
    rows = texts.select(F.explode(F.when(sound, entries).otherwise(broken)).alias("e")).select("e.*")
    return rows if kind is None else rows.where(F.col("kind") == kind)


def read_series(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """A daily series' rows by date: date, article_id, title, post, pilgrim_count; keys that are no dates are dropped.

    Counts may be numbers, whose fractions go, or text that is a whole number without separators.
    """
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", SERIES_JSON)).alias("key", "r"))
    n = F.col("r.data.pilgrim_count")
    count = F.when(n.rlike("^\\s*[+-]?[0-9]+\\s*$"), n.try_cast("bigint")).otherwise(F.when(n.rlike("^-?[0-9]+\\.[0-9]+([eE][+-]?[0-9]+)?$"), n.try_cast("double").try_cast("bigint")))
    rows = rows.select(calendar_date(F.col("key")).alias("date"), "r.article_id", "r.title", "r.post", count.alias("pilgrim_count")).where("date is not null")
    if required and rows.isEmpty():
        raise ValueError(f"{path} has no dated rows")
    return rows.orderBy("date")
