import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daystack.config import RunConfig
from daystack.operators import articles, batching, charts, daily, lifecycle, rates


def test_displacement_of_one_day(spark):
    rows = spark.createDataFrame([("d", n, k) for k, n in enumerate([5, 9, 9, 7, 12], 1)], "date string, pilgrim_count long, seq long")
    assert daily.daily_best(rows).first().seq == 5
    lists = daily.displaced_lists(daily.displaced(rows), ["pilgrim_count"]).first().displaced
    assert [(x.pilgrim_count, x.reason) for x in lists] == [(5, daily.REPLACED), (9, daily.LOWER), (7, daily.LOWER), (9, daily.REPLACED)]


def test_ties_keep_the_first(spark):
    rows = spark.createDataFrame([("d", 9, 2), ("d", 9, 1)], "date string, pilgrim_count long, seq long")
    assert daily.daily_best(rows).first().seq == 1


def loop_batches(tokens, budget):
    out, batch, filled = [], 0, -1
    for n in tokens:
        if n > budget:
            batch, filled = batch + 1, -1
        elif filled < 0 or filled + n > budget:
            batch, filled = batch + 1, n
        else:
            filled += n
        out.append(batch)
    return out


@pytest.mark.parametrize("tokens, expected", [([30, 50, 40, 120, 10, 90], [1, 1, 2, 3, 4, 4]), ([120, 10], [1, 2]), ([100, 1], [1, 2]), ([], []), ([0, 0], [1, 1])])
def test_token_batches(spark, tokens, expected):
    rows = spark.createDataFrame(list(enumerate(tokens)), "seq long, tokens long")
    assert [r.batch_id for r in batching.token_batches(rows, 100).orderBy("seq").collect()] == expected


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_token_batches_do_not_depend_on_partitions(spark, parts):
    rng = random.Random(parts)
    tokens = [rng.choice([1, 5, 20, 60, 99, 150]) for _ in range(700)]
    rows = spark.createDataFrame(list(enumerate(tokens)), "seq long, tokens long").repartition(5)
    assert [r.batch_id for r in batching.token_batches(rows, 100, parts=parts).orderBy("seq").collect()] == loop_batches(tokens, 100)


def test_token_batches_of_equal_lengths_take_two_passes(spark):
    """Stretches of equal rows never agree by themselves; still, no stretch is read again."""
    rows = spark.range(1000).selectExpr("id AS seq", "7L AS tokens")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("equal", "")
    got = batching.token_batches(rows, 50, parts=64).orderBy("seq").collect()
    jobs = tracker.getJobIdsForGroup("equal")
    spark.sparkContext.setJobGroup("", "")
    assert [r.batch_id for r in got] == [k // 7 + 1 for k in range(1000)]
    assert len(jobs) <= 8  # ranges, checkpoint, maps, result; not one for each stretch


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 150), min_size=1, max_size=60), st.integers(0, 100))
def test_stretch_maps(tokens, filled):
    import numpy as np

    t = np.array(tokens, np.int64)
    opens, after = batching.greedy_cuts(t, 100, filled)
    above, opened, left = batching.stretch_map(t, 100)
    at = int(np.searchsorted(above, 100 - filled, "right"))
    got = (int(opened[at]), int(left[at])) if at < len(above) else (0, filled + sum(tokens))
    assert got == (int(opens.sum()), after)


@pytest.mark.parametrize("partitions", [1, 5])
def test_displaced_over_ranges(spark, partitions):
    rng = random.Random(partitions)
    data = [(f"d{rng.choice([1, 1, 1, 2, 3])}", rng.randrange(40), k) for k in range(300)]
    rows = spark.createDataFrame(data, "date string, pilgrim_count long, seq long").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.seq: (r.reason, r.displaced_at) for r in daily.displaced(rows).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, best = {}, {}
    for date, n, k in data:
        if date in best and n <= best[date][0]:
            want[k] = (daily.LOWER, k)
        else:
            if date in best:
                want[best[date][1]] = (daily.REPLACED, k)
            best[date] = (n, k)
    assert got == want


def test_payloads_are_parsed_once(spark):
    rows = spark.createDataFrame([(1, "2100", "02", '{"day": 3, "pilgrim_count": 5}')], "seq long, year string, month string, payload string")
    out = daily.daily_best(daily.validated(rows).where("outcome = 'extracted_success'").select("date", "pilgrim_count", "seq"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1, plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 150), max_size=60), st.integers(-1, 100))
def test_greedy_cuts(tokens, filled):
    import numpy as np

    opens, _ = batching.greedy_cuts(np.array(tokens, int), 100, -1)
    ids = opens.cumsum().tolist()
    assert ids == loop_batches(tokens, 100)
    groups = {k: [n for n, i in zip(tokens, ids) if i == k] for k in ids}
    assert all(sum(g) <= 100 or len(g) == 1 for g in groups.values())


def test_fixed_chunks(spark):
    got = batching.fixed_chunks(spark.range(10).withColumnRenamed("id", "seq"), 4).orderBy("seq").collect()
    assert [r.chunk for r in got] == [0] * 4 + [1] * 4 + [2] * 2


def test_sliding_sum_leaves_out_the_lower_bound(spark):
    t = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(t, 1), (t + timedelta(seconds=59.999999), 2), (t + timedelta(seconds=60), 4)], "ts timestamp, n long")
    assert [r.current for r in rates.sliding_sum(rows, "ts", "n", 60).orderBy("ts").collect()] == [1, 3, 6]


def test_sliding_sum_equals_a_loop(spark):
    rng, t = random.Random(3), datetime(2024, 1, 1)
    data = [(k, t + timedelta(seconds=rng.randrange(5000)), rng.randrange(9)) for k in range(400)]
    rows = spark.createDataFrame(data, "k long, ts timestamp, n long")
    got = {r.k: r.current for r in rates.sliding_sum(rows, "ts", "n", 300).collect()}
    assert got == {k: sum(n for _, b, n in data if a - timedelta(seconds=300) < b <= a) for k, a, _ in data}


def test_sliding_sum_takes_no_step_for_each_row_of_a_window(spark):
    """Rows of one time, without a time and without tokens; the sums' frames start at the stretch and never slide."""
    t = datetime(2024, 1, 1)
    data = [(k, t + timedelta(seconds=k % 7), 1) for k in range(2000)] + [(2000, None, 5), (2001, None, 6), (2002, t + timedelta(hours=1), None)]
    got = rates.sliding_sum(spark.createDataFrame(data, "k long, ts timestamp, n long"), "ts", "n", 3)
    assert "RangeFrame" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {k: sum(n for _, b, n in data if b == a or a and b and a - timedelta(seconds=3) < b <= a) if n else None for k, a, n in data}
    assert {r.k: r.current for r in got.collect()} == want


def test_running_balance_equals_a_loop(spark):
    rng, t, balance, want = random.Random(5), datetime(2024, 1, 1), 0, []
    data = [(k, t + timedelta(minutes=30 * k), rng.randint(-20, 20)) for k in range(600)]
    for _, _, d in data:
        balance = max(0, balance + d)
        want.append(balance)
    rows = spark.createDataFrame(data, "k long, ts timestamp, d long")
    assert [r.balance for r in rates.running_balance(rows, "ts", "k", "d", 7200).orderBy("k").collect()] == want


def test_waits():
    tracker = rates.RateTracker(100, 1.0)
    assert rates.simulated_waits([(0, 60), (1, 60), (2, 10)], tracker) == [0, 60, 0]
    with pytest.raises(TimeoutError):
        rates.simulated_waits([(0, 101)], rates.RateTracker(100, 1.0))


def test_stalls_and_timeouts(spark):
    t = datetime(2024, 1, 1)
    rows = spark.createDataFrame([("b", t + timedelta(seconds=s), n) for s, n in ((0, 0), (10, 1), (70, 1), (71, 1))], "batch_id string, ts timestamp, processed long")
    got = lifecycle.timeouts(lifecycle.stalls(rows, "batch_id", "ts", "ts", "processed", 60), "batch_id", "ts", 70).orderBy("ts").collect()
    assert [r.stalled for r in got] == [False, False, False, True]
    assert [r.timed_out for r in got] == [False, False, False, True]


def test_decision_order(spark):
    rows = spark.createDataFrame([("completed", True, True), ("cancelled", True, True), ("in_progress", False, True), ("validating", False, False)], "s string, t boolean, x boolean")
    assert [r[0] for r in rows.select(lifecycle.decision(F.col("s"), F.col("t"), F.col("x"))).collect()] == ["completed", "timeout", "stalled", "wait"]


def test_queues():
    q = lifecycle.Queues(1)
    q.put("extraction", ["e"])
    q.put("classification", ["c"])
    kind, batch = q.next()
    assert (kind, batch) == ("classification", ["c"])
    assert q.failed(kind, batch) and q.failed(kind, batch) and not q.failed(kind, batch)
    q.submitted("1")
    assert q.next() is None
    q.done("1")
    assert q.next() is not None


def test_first_wins_prefers_retry(spark):
    rows = spark.createDataFrame([("a", 1, "f", 0, "x"), ("a", 0, "z", 5, "y"), ("b", 1, "f", 1, "x")], "article_id string, source_rank int, file string, row_seq long, v string")
    assert {r.article_id: r.v for r in articles.first_wins(rows, "article_id", ["source_rank", "file", "row_seq"]).collect()} == {"a": "y", "b": "x"}


def test_charts_of_an_empty_month(spark):
    rows = spark.sql("select date'2024-01-05' as date, 5L as pilgrim_count union all select date'2024-03-01', 7L union all select date'2024-03-02', 7L")
    spine = charts.year_spine(rows).orderBy("month").collect()
    assert [r.month_max for r in spine][:4] == [5, None, 7, None] and [r.is_max for r in spine][:3] == [False, False, True]
    assert charts.month_view(rows, "2024-03").where("is_max").count() == 2
    assert charts.year_months(rows).first().months == ["2024-01", "2024-03"]


@pytest.mark.parametrize("bad", [{"batch_size": 0}, {"batch_size": 10_001}, {"max_inflight_batches": 0}, {"tpm_pace_threshold": 0}, {"enqueued_pace_threshold": 1.1}, {"period_from": "x"}])
def test_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        RunConfig(**bad)
