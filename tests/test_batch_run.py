import json

import pytest

from daystack import cli
from daystack.config import RunConfig
from daystack.plans.batch_run import BatchRunner, earlier_rows
from daystack.plans.pipeline import run
from daystack.providers.base import FakeBatchClient
from daystack.providers.service import is_transient, stated_limit, submit
from tests.test_pipeline import news  # noqa: F401  a fixture


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds


class Moody(FakeBatchClient):
    """Fails, hangs and throttles by plan: what each submission does, in order."""

    def __init__(self, *moods):
        super().__init__()
        self.moods, self.seen, self.most = list(moods), {}, 0

    def submit(self, lines):
        mood = self.moods.pop(0) if self.moods else "ok"
        if mood == "throttled":
            raise type("E", (Exception,), {"status_code": 429})("Limit: 1,000,000 enqueued")
        if mood == "broken":
            raise ValueError("no")
        batch = super().submit(lines)
        self.seen[batch] = mood
        return batch

    def status(self, batch_id):
        self.most = max(self.most, sum(b["status"] == "in_progress" for b in self.batches.values()))
        mood = self.seen[batch_id]
        return {"status": "in_progress", "processed": 1} if mood == "hangs" else {"status": "failed"} if mood == "fails" else super().status(batch_id)


@pytest.fixture
def articles(spark, news):  # noqa: F811
    return run(spark, str(news)).articles


def test_batch_mode_gives_what_row_by_row_gives(spark, news, articles):  # noqa: F811
    clock = Clock()
    runner = BatchRunner(FakeBatchClient(), RunConfig(max_tokens_per_batch=250, max_inflight_batches=2), clock, clock.sleep)
    got = runner.run(spark, articles)
    assert len(runner.client.batches) > 3 and runner.enqueued == 0
    assert sorted(got.series.collect()) == sorted(run(spark, str(news)).series.collect())


def test_stalled_batches_go_again_and_failed_ones_are_listed(spark, articles):
    clock = Clock()
    client = Moody("throttled", "throttled", "hangs", "ok", "fails")
    runner = BatchRunner(client, RunConfig(max_retries=1, batch_stall_timeout=60), clock, clock.sleep)
    got = runner.run(spark, articles)
    assert client.batches["batch-1"]["status"] == "cancelled" and runner.limit == 1_000_000
    assert got.labels.count() == 5 and got.series.count() == 0
    assert {r.article_id for r in runner.failed_articles(spark).collect()} == {"p-1", "p-2", "p-4"}


def test_timeouts_and_refusals_end(spark, articles):
    clock = Clock()
    runner = BatchRunner(Moody("hangs"), RunConfig(per_batch_timeout=100, batch_stall_timeout=10_000), clock, clock.sleep)
    assert runner.run(spark, articles).labels.count() == 0 and runner.failed_articles(spark).count() == 5
    runner = BatchRunner(Moody(*["broken"] * 9), RunConfig(max_retries=1), clock, clock.sleep)
    assert runner.run(spark, articles).labels.count() == 0 and len(runner.failed) == 1


def test_submission():
    waits = []
    assert submit(Moody("throttled", "throttled"), ["x"], 3, waits.append) == "batch-1" and 5 <= waits[0] <= 8 and 10 <= waits[1] <= 13
    with pytest.raises(ValueError):
        submit(Moody("broken"), ["x"], 3, waits.append)
    assert is_transient(TimeoutError()) and is_transient(OSError(104, "x")) and not is_transient(ValueError())
    assert [stated_limit(x) for x in ("Limit: 2,000,000 enqueued", "no", "Limit: 0 enqueued")] == [2_000_000, None, None]


def test_going_on_from_a_state(spark, news, tmp_path):  # noqa: F811
    result = run(spark, str(news))
    record = {"article_id": "old", "title": "t", "post": "p", "data": {"pilgrim_count": 10**6, "other_metrics": {}}}
    result.earlier = earlier_rows(spark, {"darshan_rows": {"2100-02-05": record}})
    assert {r.date: r.article_id for r in result.series.collect()} == {"2100-02-05": "old", "2100-03-31": "p-4"}
    state = tmp_path / "state.json"
    state.write_text(json.dumps({"darshan_rows": {"2100-02-05": record}, "failed_records": [], "metrics": {}, "pending_batches": [], "date_duplicates": {}}))
    assert cli.main(["run", str(news), "--output", str(tmp_path / "out"), "--resume-from-state", str(state), "--client", "daystack.providers.base:FakeBatchClient", "--poll-interval", "10", "--per-record"]) == 0
    out = next((tmp_path / "out").iterdir())
    assert json.loads((out / "series.json").read_text())["2100-02-05"]["article_id"] == "old"
    assert json.loads((out / "state.json").read_text())["darshan_rows"]["2100-03-31"]
