"""Reading responses and extracted payloads, with types told apart before they are converted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daystack.functions.text import clean_count, strip, strip_fences
from daystack.schemas import RESULT_LINE

INVALID_DATE, FAILED, SUCCESS = "invalid_date", "extracted_failed", "extracted_success"


def parse(text: Column) -> Column:
    """A variant, or null for what is not JSON."""
    return F.try_parse_json(text)


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.variant_get(v, path, "variant"))


def _whole(v: Column, path: str) -> Column:
    """A JSON integer, with true as 1 and false as 0; null for any other type."""
    kind = _kind(v, path)
    as_bool = F.try_variant_get(v, path, "boolean").cast("int").cast("bigint")
    return F.when(kind == "BIGINT", F.try_variant_get(v, path, "bigint")).when(kind == "BOOLEAN", as_bool)


def day_of(v: Column) -> Column:
    """The payload's day, a JSON integer from 1 to 31, or null."""
    day = _whole(v, "$.day")
    return F.when(day.between(1, 31), day)


def count_of(v: Column) -> Column:
    """The payload's pilgrim_count: an integer of at least 0, or text that is one with separators; or null."""
    n = F.when(_kind(v, "$.pilgrim_count") == "STRING", clean_count(F.try_variant_get(v, "$.pilgrim_count", "string"))).otherwise(_whole(v, "$.pilgrim_count"))
    return F.when(n >= 0, n)


def metrics_of(v: Column) -> Column:
    """other_metrics as JSON text, {} where it is no object."""
    kind = _kind(v, "$.other_metrics")
    return F.coalesce(F.when(kind.startswith("OBJECT"), F.to_json(F.variant_get(v, "$.other_metrics", "variant"))), F.lit("{}"))


def outcome(day: Column, count: Column) -> Column:
    """What a payload counts as; the day is looked at first."""
    return F.when(day.isNull(), INVALID_DATE).when(count.isNull(), FAILED).otherwise(SUCCESS)


def response_text(line: Column) -> Column:
    """A result line's text: null after an error or without choices."""
    r = F.from_json(line, RESULT_LINE)
    failed = r["error"].isNotNull() & ~r["error"].isin("", "null", "false", "0", "{}", "[]")
    return F.when(~failed, strip(F.try_element_at(r["response"]["body"]["choices"], F.lit(1))["message"]["content"]))


def parsed_response(text: Column, kind: str) -> Column:
    """A label in lower case, an extraction as JSON text without fences (null if it isn't JSON), or the text itself."""
    empty = text.isNull() | (text == "")
    if kind == "classification":
        return F.when(~empty, F.lower(text))
    if kind == "extraction":
        inner = strip_fences(text)
        return F.when(~empty & parse(inner).isNotNull(), inner)
    return F.when(~empty, text)
