import json
from datetime import datetime, timedelta

import pytest

from daystack import cli
from daystack.config import RunConfig
from daystack.plans import pipeline
from daystack.providers.base import FakeBatchClient, RuleProvider, provider
from daystack.sinks import files
from daystack.sinks.chart import render
from daystack.sources import articles, batches, states

HEAD = "year,month,page,article_id,title,link,content\n"


@pytest.fixture
def news(tmp_path):
    """Two files: a repeated header, quotes and line ends in fields, blank and short lines, no final line end."""
    folder = tmp_path / "news"
    folder.mkdir()
    (folder / "articles_2100_02.csv").write_text(
        HEAD + 'year,month,page,article_id,title,link,content\n2013,10,1,p-1,"A ""b""",l1,"Pilgrims who had darshan on 05.10.2013: 1,200\nmore"\n\n2013,10,1,p-2,t,l2,"About 3,400 pilgrims came on October 5"\n2013,10,1,p-3,t,l3,nothing here\n2013,10\n2013,10,1,  ,t,l,no id\n'
    )
    (folder / "articles_2100_03.csv").write_text(HEAD + "2013,11,1,p-2,t,l2,About 9,999,x\n2013,11,1,p-4,t,l4,\"About 2,000 pilgrims came on Nov 31\"")
    (folder / "articles.csv").write_text(HEAD + "2013,11,1,p-9,t,l,About 1 pilgrims")
    return folder


def test_reading(spark, news):
    rows = {(r.article_id, r.month) for r in articles.read_articles(spark, str(news)).collect()}
    assert rows == {("article_id", "02"), ("p-1", "02"), ("p-2", "02"), ("p-3", "02"), ("p-2", "03"), ("p-4", "03")}
    assert {r.month for r in articles.read_articles(spark, str(news), "row").where("article_id = 'p-4'").collect()} == {"11"}
    assert "\n" in articles.read_articles(spark, str(news)).where("article_id = 'p-1'").first().content
    assert articles.count_rows(spark, str(news)).first()[0] == 9


def test_run(spark, news):
    run = pipeline.run(spark, str(news))
    assert {r.date: (r.article_id, r.pilgrim_count) for r in run.series.collect()} == {"2100-02-05": ("p-2", 3400), "2100-03-31": ("p-4", 2000)}
    gone = run.displaced.first()
    assert gone.date == "2100-02-05" and [x.article_id for x in gone.displaced] == ["p-1"]
    c = run.counters.first()
    assert (c.total_loaded, c.classified_true, c.classified_false, c.final_records) == (5, 3, 2, 2)
    assert run.failed.count() == 0
    assert pipeline.batches(run.articles, RunConfig()).select("batch_id").distinct().count() == 1


def test_outputs(spark, news, tmp_path):
    run = pipeline.run(spark, str(news))
    files.write_series(run.series, str(tmp_path / "s.json"))
    files.write_displaced(run.displaced_rows, str(tmp_path / "d.json"))
    assert json.loads((tmp_path / "s.json").read_text())["2100-02-05"]["data"] == {"pilgrim_count": 3400, "other_metrics": {}}
    assert json.loads((tmp_path / "d.json").read_text())["2100-02-05"][0]["reason"] == "replaced by higher pilgrim_count"
    assert files.write_failed(run.failed, str(tmp_path), "x") is None
    bad = files.write_failed(run.articles.select("article_id", "content"), str(tmp_path), "x")
    assert articles.read_csv(spark, bad).count() == 5


def test_retry_goes_first(spark, news, tmp_path):
    (tmp_path / "again.csv").write_text(HEAD + '2099,01,1,p-3,t,l,"About 5,000 pilgrims came on Jan 2"\n,01,1,p-5,t,l,x')
    run = pipeline.run(spark, str(news), retry=str(tmp_path / "again.csv"))
    assert {r.date for r in run.series.collect()} == {"2099-01-02", "2100-02-05", "2100-03-31"}


def test_state(spark, tmp_path):
    path = str(tmp_path / "state.json")
    state = {"darshan_rows": {}, "failed_records": [], "metrics": {}, "date_duplicates": {}, "pending_batches": [{"kind": "extraction", "batch_id": "b", "article_ids": ["p"], "estimated_tokens": 5}]}
    assert files.save_state(path, state) and states.load_state(spark, path) == state
    assert states.read_ledger(spark, path).first().article_ids == ["p"]
    assert states.read_ledger(spark, path, "classification").count() == 0
    assert states.load_state(spark, str(tmp_path / "none.json")) is None and states.read_ledger(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "odd.json").write_text("{}")
    assert states.load_state(spark, str(tmp_path / "odd.json")) is None


def test_ledger_in_parts(spark, tmp_path):
    """A line is an object of its own, so no task needs more than a line; all lines of all files count."""
    line = lambda k: json.dumps({"pending_batches": [{"kind": "extraction", "batch_id": f"b{k}", "article_ids": [f"}}{k}\n"], "estimated_tokens": k}]})
    for part in range(3):
        (tmp_path / f"part-{part}").write_text("\n".join([*map(line, range(part * 10, part * 10 + 10)), "", '{"metrics": {}}\n']))
    got = {(r.batch_id, r.article_ids[0], r.estimated_tokens) for r in states.read_ledger(spark, str(tmp_path), "extraction").collect()}
    assert got == {(f"b{k}", f"}}{k}\n", k) for k in range(30)}


@pytest.mark.parametrize("bad", ["", "[]", '{"pending_batches": [', '{"pending_batches": []}\n{"pending_batches": [{"kind"', '{"pending_batches": [{"article_ids": 5}]}', '{\n"pending_batches": [\n'])
def test_a_ledger_that_cannot_be_read_is_no_empty_ledger(spark, tmp_path, bad):
    (tmp_path / "state.json").write_text(bad)
    with pytest.raises(Exception):
        states.read_ledger(spark, str(tmp_path / "state.json")).collect()
    with pytest.raises(Exception):
        states.read_ledger(spark, str(tmp_path / "state.json"), "extraction").count()


def test_other_failures_of_reading_a_ledger_are_errors(spark):
    with pytest.raises(Exception):
        states.read_ledger(spark, "nosuchscheme://host/state.json").count()


def test_series_and_chart(spark, tmp_path):
    rec = lambda n: {"article_id": "a", "title": "t", "post": "p", "data": {"pilgrim_count": n, "other_metrics": {}}}
    (tmp_path / "s.json").write_text(json.dumps({"2100-02-31": rec(1), "2024-1-5": rec(3.7), "x": rec(1), "2024-01-06": rec("64,801"), "2024-01-07": rec(9)}))
    rows = states.read_series(spark, str(tmp_path / "s.json"))
    assert [(str(r.date), r.pilgrim_count) for r in rows.collect()] == [("2024-01-05", 3), ("2024-01-06", None), ("2024-01-07", 9)]
    render(rows, str(tmp_path / "c.html"))
    page = (tmp_path / "c.html").read_text()
    assert "2024-01-07" in page and "%ROWS%" not in page
    (tmp_path / "e.json").write_text("{}")
    with pytest.raises(ValueError):
        states.read_series(spark, str(tmp_path / "e.json"))


def pages(after, limit):
    """A service of 25 batches, for the listing's test."""
    rows = [{"batch_id": f"b{k:02}", "status": "completed" if k % 2 else "in_progress", "created_at": k} for k in range(25)]
    at = next((k + 1 for k, r in enumerate(rows) if r["batch_id"] == after), 0)
    return rows[at : at + limit], at + limit < len(rows)


def test_listing(spark):
    assert batches.list_batches(spark, "tests.test_pipeline:pages", page_size=10).count() == 25
    assert batches.list_batches(spark, "tests.test_pipeline:pages", "completed", 10, 2).count() == 10


def test_results(spark, tmp_path):
    client = FakeBatchClient()
    line = json.dumps({"custom_id": "p-extraction", "body": {"messages": [{"role": "user", "content": "About 3,400 pilgrims came on October 5"}]}})
    batch = client.submit([line])
    assert client.status(batch)["status"] == "completed" and client.cancel(batch) and not client.cancel("x")
    (tmp_path / "r.jsonl").write_text("\n".join(client.results(batch)) + "\n\n")
    r = batches.read_results(spark, str(tmp_path / "r.jsonl")).collect()
    assert len(r) == 1 and json.loads(r[0].text)["pilgrim_count"] == "3,400"
    assert isinstance(provider(), RuleProvider)
    a, b = spark.sql("select 'c' as code, 'm' as message"), spark.sql("select 'l' as line")
    assert batches.all_errors(a, b).count() == 2


def test_command_line(spark, news, tmp_path):
    assert cli.main(["run", str(news), "--output", str(tmp_path / "out")]) == 0
    out = next((tmp_path / "out").iterdir())
    assert {"series.json", "displaced.json", "run_metadata.json", "state.json"} <= {p.name for p in out.iterdir()}
    assert cli.main(["chart", "--data-file", str(out / "series.json"), "--output-file", str(tmp_path / "c.html")]) == 0
    assert cli.main(["run", str(tmp_path / "none")]) == 2
    assert cli.main(["cancel", "--client", "tests.test_pipeline:pages"]) == 0


def test_streaming_lifecycle(spark, tmp_path):
    from daystack.streaming.lifecycle import POLLS, batch_events, first_articles, token_rates

    t = datetime(2024, 1, 1)
    source = tmp_path / "polls"
    source.mkdir()

    def write(k, rows):
        (source / f"{k}.json").write_text("\n".join(json.dumps({"batch_id": b, "ts": (t + timedelta(seconds=s)).isoformat(), "status": x, "processed": n}) for b, s, x, n in rows))

    def step(k, rows):
        write(k, rows)
        stream = batch_events(spark.readStream.schema(POLLS).json(str(source)), 100, 1000)
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return {(r.batch_id, r.event) for r in spark.read.schema("batch_id string, at timestamp, event string, processed long").parquet(str(tmp_path / "out")).collect()}

    assert step(0, [("a", 0, "in_progress", 0), ("b", 0, "in_progress", 0), ("c", 0, "in_progress", 0)]) == set()
    # a ends, b stands still for too long, c goes on; the query starts again from its checkpoint each time
    assert step(1, [("a", 50, "completed", 5), ("b", 101, "in_progress", 0), ("c", 90, "in_progress", 1)]) == {("a", "completed"), ("b", "stalled")}
    got = step(2, [("d", 5000, "in_progress", 0), ("d", 5001, "in_progress", 1)])
    assert ("c", "stalled") in got or ("c", "timeout") in got or ("c", "stalled") in step(3, [("d", 5002, "in_progress", 2)])
    assert token_rates(spark.readStream.format("rate").load().selectExpr("timestamp as ts", "value as tokens")).isStreaming
    assert first_articles(spark.readStream.format("rate").load().selectExpr("timestamp as ts", "cast(value as string) as article_id")).isStreaming


def test_streaming_daily_table(spark, tmp_path):
    from daystack.streaming.lifecycle import into_daily_table

    source = tmp_path / "in"
    for k, n in enumerate((5, 9, 7)):
        spark.createDataFrame([("d", n, k)], "date string, pilgrim_count long, seq long").write.parquet(str(source / str(k)))
        rows = spark.readStream.schema("date string, pilgrim_count long, seq long").parquet(str(source / "*"))
        into_daily_table(rows, str(tmp_path / "t"), str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "t/batch=2")).first().pilgrim_count == 9
