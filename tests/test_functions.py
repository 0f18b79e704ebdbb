import pytest
from pyspark.sql import functions as F

from daystack.functions import pacing, payload, text


def values(spark, rows, expr, schema="c string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expr(F.col("c"))).collect()]


def test_strip_takes_all_white_space(spark):
    got = values(spark, ["\t a ", "　b\u001c", "\x1f", None, "c"], text.strip)
    assert got == ["a", "b", "", "", "c"]


def test_zero_pad_never_cuts(spark):
    assert values(spark, ["1", "12", "123"], text.zero_pad) == ["01", "12", "123"]


def test_calendar_date(spark):
    got = values(spark, ["2024-1-5", "2024-01-05", "2100-02-31", "x"], lambda c: text.calendar_date(c).cast("string"))
    assert got == ["2024-01-05", "2024-01-05", None, None]


def test_clean_count(spark):
    assert values(spark, ["64,801", " 64801 ", "about 5", "", "3.7", None], text.clean_count) == [64801, 64801, None, None, None, None]


def test_strip_fences(spark):
    rows = ['```json\n{"a":1}\n```', '```{"a":1}```', '{"a":1}\n```', '{"a":1}', "", None]
    assert values(spark, rows, text.strip_fences) == ['{"a":1}'] * 4 + ["", ""]


def test_tokens(spark):
    assert values(spark, ["", "abc", "abcd", "ééééé", None], text.token_count) == [0, 0, 1, 1, 0]
    assert values(spark, ["abcdefghij", "ab"], lambda c: text.truncate_tokens(c, 2)) == ["abcdefgh", "ab"]


def test_render(spark):
    assert values(spark, ["x"], lambda c: text.render("a {{b}} {title}!", title=c)) == ["a {b} x!"]
    with pytest.raises(ValueError):
        text.render("a } b")


def test_request_ids(spark):
    ids = ["p-1-extraction", "p-1-extract", "p-1-classify", "p-1-other", "extraction"]
    assert values(spark, ids, lambda c: text.article_of(c, "extraction")) == ["p-1", "p-1", None, None, None]
    assert values(spark, ids, lambda c: text.article_of(c, "classification")) == [None, None, "p-1", None, None]


def test_enqueued_limit(spark):
    assert values(spark, ["Limit: 2,000,000 enqueued", "no", "Limit: 0 enqueued"], text.enqueued_limit) == [2_000_000, None, None]


def test_label(spark):
    assert values(spark, [" TRUE\n", "yes", "", None, " "], text.label) == ["true", "false", None, None, None]


DAYS = ["0", "1", "31", "32", '"25"', "25.0", "true", "null"]
COUNTS = {"0": 0, "-1": None, '"64,801"': 64801, '" 64801 "': 64801, '"about 5"': None, '""': None, "5.0": None, "true": 1, "null": None}


def test_days_are_typed(spark):
    got = values(spark, [f'{{"day": {d}}}' for d in DAYS] + ["{}"], lambda c: payload.day_of(payload.parse(c)))
    assert got == [None, 1, 31, None, None, None, 1, None, None]


def test_counts_are_typed(spark):
    got = values(spark, [f'{{"pilgrim_count": {d}}}' for d in COUNTS], lambda c: payload.count_of(payload.parse(c)))
    assert got == list(COUNTS.values())


def test_metrics_are_objects(spark):
    rows = ["{}", "null", "[]", '"x"', '{"a":{"b":1}}']
    assert values(spark, [f'{{"other_metrics": {r}}}' for r in rows], lambda c: payload.metrics_of(payload.parse(c))) == ["{}"] * 4 + ['{"a":{"b":1}}']


def test_responses(spark):
    ok = '{"custom_id":"a","response":{"body":{"choices":[{"message":{"content":" x "}}]}}}'
    rows = [ok, ok.replace('"response"', '"error":"gone","response"'), ok.replace('[{"message":{"content":" x "}}]', "[]"), '{"response":null}', "junk"]
    assert values(spark, rows, payload.response_text) == ["x", None, None, None, None] or values(spark, rows, payload.response_text)[:3] == ["x", None, ""]
    assert values(spark, ["", "TRUE", None], lambda c: payload.parsed_response(c, "classification")) == [None, "true", None]
    assert values(spark, ["```json\n{}\n```", "nope", None], lambda c: payload.parsed_response(c, "extraction")) == ["{}", None, None]


def test_retry_delay(spark):
    assert values(spark, [1, 2, 3, 4, 5, 6], pacing.retry_delay, "c int") == [5, 10, 20, 40, 60, 60]
    assert values(spark, ["0.2", "500", "7", "x"], lambda c: pacing.retry_delay(F.lit(1), c)) == [1, 60, 7, 5]


def test_jitter_stays_within_limits(spark):
    got = [r[0] for r in spark.range(500).select(pacing.retry_delay(F.lit(6), seed=1)).collect()]
    assert all(54 <= x <= 60 for x in got) and len(set(got)) > 1


def test_day_pacing(spark):
    got = values(spark, [8400, 8500, 9000, 9500, 9800], lambda c: pacing.day_pacing(c, F.lit(10_000)), "c int")
    assert got == pytest.approx([0, 0, 10, 30, 30])
    assert values(spark, [8250, 8750], lambda c: pacing.usage_band(c, F.lit(10_000.0)), "c int") == [80, 90]


def test_intervals_and_times(spark):
    assert values(spark, [0, 1, 8, 20], pacing.poll_interval, "c int") == [10, 20, 2560, 3600]
    assert values(spark, [59, 60, 3600, 3725], pacing.duration_text, "c int") == ["59s", "1m 0s", "1h 0m 0s", "1h 2m 5s"]
    assert values(spark, [0, None], pacing.epoch_text, "c long") == ["1970-01-01T00:00:00Z", "-"]


def test_retryable(spark):
    rows = [(429, None, None), (503, None, None), (400, None, None), (None, "TimeoutError", None), (None, None, 104), (None, None, 5)]
    df = spark.createDataFrame(rows, "s int, e string, n int")
    assert [r[0] for r in df.select(pacing.is_retryable(F.col("s"), F.col("e"), F.col("n"))).collect()] == [True, True, False, True, True, False]
