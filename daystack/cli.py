"""Command line: run, chart, batches, cancel."""

from __future__ import annotations

import argparse
import importlib
import json
import logging
import signal
import sys
import time
from dataclasses import fields
from datetime import datetime
from pathlib import Path

from daystack.config import RunConfig
from daystack.session import local_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="daystack")
    commands = p.add_subparsers(dest="command", required=True)
    r = commands.add_parser("run", help="articles to daily series")
    r.add_argument("directory")
    for f in fields(RunConfig):
        flag = "--" + f.name.replace("_", "-")
        if f.type == "bool":
            r.add_argument(flag, action="store_true")
        else:
            r.add_argument(flag, type={"int": int, "float": float}.get(f.type, str), default=f.default)
    r.add_argument("--retry-failed")
    r.add_argument("--state-file")
    r.add_argument("--resume-from-state")
    r.add_argument("--provider", default="rules")
    r.add_argument("--client", help="module:Class of a batch service; without it, or with --per-record, the provider is asked row by row")
    r.add_argument("--output", default="output")
    c = commands.add_parser("chart", help="daily series to a page")
    c.add_argument("--data-file", required=True)
    c.add_argument("--output-file", default="chart.html")
    for name, pages in (("batches", 10), ("cancel", 50)):
        b = commands.add_parser(name, help="a service's batches" if name == "batches" else "cancel those that are open")
        b.add_argument("--client", required=True, help="module:function that returns a page")
        b.add_argument("--status")
        b.add_argument("--page-size", type=int, default=100)
        b.add_argument("--max-pages", type=int, default=pages)
        if name == "cancel":
            b.add_argument("--yes", action="store_true")
            b.add_argument("--cancel-with", help="module:function that takes a batch id")
    return p


def config_of(args: argparse.Namespace) -> RunConfig:
    return RunConfig(**{f.name: getattr(args, f.name) for f in fields(RunConfig)})


def _run(args: argparse.Namespace) -> int:
    from daystack.plans.batch_run import earlier_rows
    from daystack.plans.pipeline import run
    from daystack.operators.daily import displaced_summary
    from daystack.operators.durable import durable
    from daystack.sinks.files import report, save_state, write_displaced, write_failed, write_metadata, write_series
    from daystack.sources.states import load_state

    if not Path(args.directory).is_dir():
        print(f"{args.directory} is no directory", file=sys.stderr)
        return 2
    config, started = config_of(args), datetime.now()
    label = started.strftime("%Y-%m-%d_%H-%M-%S-%f")
    out = Path(args.output) / label
    out.mkdir(parents=True)
    state_file = args.state_file or str(out / "state.json")
    spark = local_session()
    state = {"darshan_rows": {}, "failed_records": [], "metrics": {}, "pending_batches": [], "date_duplicates": {}}
    before = {}
    if args.resume_from_state and (old := load_state(spark, args.resume_from_state)):
        state, before = old, old["metrics"]

    def stop(number, frame) -> None:
        save_state(state_file, state)
        if number != signal.SIGUSR1:
            sys.exit(1)

    for number in (signal.SIGINT, signal.SIGTERM, signal.SIGUSR1):
        signal.signal(number, stop)
    if args.client and not config.per_record:
        from daystack.plans.batch_run import BatchRunner
        from daystack.plans.pipeline import load

        module, _, cls = args.client.partition(":")
        runner = BatchRunner(getattr(importlib.import_module(module), cls)(), config)
        result = runner.run(spark, load(spark, args.directory, config, args.retry_failed))
    else:
        result = run(spark, args.directory, config, args.provider, args.retry_failed)
    if state["darshan_rows"]:
        result.earlier = earlier_rows(spark, state)
    counters = result.counters.first().asDict()
    files = {"series": str(out / "series.json"), "displaced": str(out / "displaced.json"), "state": state_file}
    write_series(result.series, files["series"])
    gone = durable(result.displaced_rows)
    write_displaced(gone, files["displaced"])
    files["failed"] = write_failed(result.failed, str(out), label)
    state |= {"metrics": counters, "darshan_rows": json.loads(Path(files["series"]).read_text()), "date_duplicates": json.loads(Path(files["displaced"]).read_text())}
    save_state(state_file, state)
    ended = datetime.now()
    write_metadata(str(out / "run_metadata.json"), label, started, ended, args.provider, config.as_dict(), before, counters, files)
    gone = displaced_summary(gone).first()
    for line in report(counters, int((ended - started).total_seconds()), gone[0], gone[1], result.failed.count()):
        logging.info(line)
    return 0


def _chart(args: argparse.Namespace) -> int:
    from daystack.sinks.chart import render
    from daystack.sources.states import read_series

    render(read_series(local_session(), args.data_file), args.output_file)
    return 0


def _batches(args: argparse.Namespace) -> int:
    from daystack.operators.lifecycle import cancel_candidates
    from daystack.sinks.files import batch_table
    from daystack.sources.batches import list_batches

    rows = list_batches(local_session(), args.client, args.status, args.page_size, args.max_pages)
    if args.command == "cancel":
        rows = cancel_candidates(rows)
    for r in batch_table(rows).toLocalIterator():
        print(r["line"])
    if args.command == "cancel" and args.yes:
        module, _, function = args.cancel_with.partition(":")
        cancel = getattr(importlib.import_module(module), function)
        for r in rows.select("batch_id").toLocalIterator():
            print(r["batch_id"], "cancelled" if cancel(r["batch_id"]) else "not cancelled")
            time.sleep(0.2)
    return 0


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parser().parse_args(argv)
    return {"run": _run, "chart": _chart, "batches": _batches, "cancel": _batches}[args.command](args)


if __name__ == "__main__":
    sys.exit(main())
