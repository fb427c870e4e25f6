"""Command line over the archive: python -m tidemark.cli COMMAND --root ARCHIVE ..."""

from __future__ import annotations

import argparse
import importlib
import json
from datetime import UTC, date, datetime
from pathlib import Path

from .functions import calendar
from .session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("--root", default="archive")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("info", help="partitions of every dataset")
    sub.add_parser("compact", help="each event of the index once")
    sub.add_parser("repair-events", help="the index anew from all partitions")
    v = sub.add_parser("verify", help="coverage report")
    v.add_argument("--universe", required=True)
    v.add_argument("--date")
    v.add_argument("--fail-under", type=float)
    u = sub.add_parser("build-universe", help="symbols from screener files")
    u.add_argument("--screener", required=True)
    u.add_argument("--existing")
    u.add_argument("--floor", type=float, default=3e8)
    u.add_argument("--out", required=True)
    q = sub.add_parser("latest", help="latest values known at a time")
    q.add_argument("--dataset", required=True)
    q.add_argument("--as-of", required=True)
    n = sub.add_parser("run", help="fetch and archive a day's snapshot")
    n.add_argument("--universe", required=True)
    n.add_argument("--symbols", help="comma-separated; the universe without it")
    n.add_argument("--datasets", help="comma-separated codes; all of them without it")
    n.add_argument("--date", required=True)
    n.add_argument("--run-id", required=True)
    n.add_argument("--fetch", required=True, help="module:function of the vendor's back end")
    n.add_argument("--resume", action="store_true")
    n.add_argument("--flush-every", type=int, default=50)
    n.add_argument("--partitions", type=int, default=1)
    d = sub.add_parser("daily-prices", help="capture the daily bars of a session")
    d.add_argument("--run-id", required=True)
    d.add_argument("--fetch", required=True)
    d.add_argument("--provider-version", required=True)
    e = sub.add_parser("verify-daily-prices", help="recompute everything about a session's bars")
    e.add_argument("--fail-under", type=float, default=0.95)
    m = sub.add_parser("market-context", help="capture the official feeds of a day")
    m.add_argument("--run-id", required=True)
    m.add_argument("--fetch", required=True)
    m.add_argument("--resume", action="store_true")
    x = sub.add_parser("verify-market-context", help="verify the official feeds of a day")
    s = sub.add_parser("seal", help="check and seal a session's snapshot")
    f = sub.add_parser("seal-full", help="check and seal a session with its prices and market context")
    b = sub.add_parser("seal-prices", help="check and seal a session's prices")
    for c in (s, f, b, d, e):
        c.add_argument("--universe", required=True)
    w = sub.add_parser("publish", help="publish a sealed session to a folder")
    y = sub.add_parser("publish-full", help="publish a sealed session with its prices and market context")
    z = sub.add_parser("publish-prices", help="publish a session's sealed prices")
    for c in (s, f, b, w, y, z, d, e, m, x):
        c.add_argument("--date", required=True)
    o = sub.add_parser("mirror", help="copy dated files to a folder")
    o.add_argument("--date")
    for c in (w, y, z, o):
        c.add_argument("--to", required=True)
    for c in (v, e, x, s, f, b):
        c.add_argument("--json-out")
    r = sub.add_parser("should-run")
    r.add_argument("--date")
    r.add_argument("--force", action="store_true")
    r.add_argument("--offset-days", type=int, default=0)
    g = sub.add_parser("schedule-gate")
    g.add_argument("--event", required=True)
    g.add_argument("--schedule")
    g.add_argument("--now")
    return p


#: Command -> folder of the bundles it publishes
PUBLISHED = {"publish": "_bundles", "publish-full": "_full_bundles", "publish-prices": "_price_bundles"}


def _function(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _report(report: dict, path: str | None) -> None:
    text = json.dumps(report, indent=2, sort_keys=True)
    print(text)
    if path:
        Path(path).write_text(text + "\n", encoding="utf-8")


def main(argv: list[str] | None = None) -> int:
    """Exit code 0 if all is well, 1 if a check fails, 2 if a gate refuses a trigger it doesn't know or that came too early."""
    a = parser().parse_args(argv)
    now = datetime.now(UTC)
    if a.command == "should-run":
        print(json.dumps(calendar.should_run(date.fromisoformat(a.date) if a.date else now.astimezone(calendar.NEW_YORK).date(), a.force, a.offset_days)))
        return 0
    if a.command == "schedule-gate":
        got = calendar.schedule_gate(a.event, a.schedule, datetime.fromisoformat(a.now) if a.now else now)
        print(json.dumps(got))
        return 0 if got["run"] or got["reason"] == "new_york_date_was_not_trading_session" else 2
    from .operators import context, coverage, evidence, price_capture, snapshot_run, universe
    from .schemas import dataset_codes
    from .sources import feeds, sinks
    from .sources.archive import Archive

    spark = build_session()
    archive = Archive(spark, a.root)
    if a.command == "info":
        archive.summary().show(50, False)
    elif a.command == "compact":
        try:
            print(f"removed {sinks.compact_events(spark, a.root)} rows")
        except ValueError as e:
            print(e)
            return 1
    elif a.command == "repair-events":
        print(json.dumps(sinks.rebuild_events(spark, a.root)))
    elif a.command == "verify":
        report = coverage.coverage_report(archive, feeds.read_universe(spark, a.universe), a.date)
        _report(report, a.json_out)
        return 0 if coverage.passes(report, a.fail_under) else 1
    elif a.command == "run":
        wanted = spark.createDataFrame([(x.strip().upper(),) for x in a.symbols.split(",") if x.strip()], "symbol string") if a.symbols else feeds.read_universe(spark, a.universe)
        log = snapshot_run.RunLog(Path(a.root) / "_logs", a.run_id)
        made = snapshot_run.run_snapshot(spark, a.root, wanted, _function(a.fetch), a.date, a.run_id, dataset_codes(a.datasets), a.resume, a.flush_every, a.partitions, log)
        print(json.dumps({k: made[k] for k in ("symbols_attempted", "symbols_skipped_resume", "events_added")} | {"failures": len(made["failures"])}))
        return 1 if made["failures"] else 0
    elif a.command == "daily-prices":
        try:
            made = price_capture.capture(spark, a.root, feeds.read_universe(spark, a.universe), date.fromisoformat(a.date), _function(a.fetch), a.run_id, a.provider_version)
        except evidence.SealError as e:
            print(e)
            return 1
        print(json.dumps({k: made[k] for k in ("status", "failures", "coverage")}, default=str))
        return 0 if made["status"] == "complete" else 1
    elif a.command == "verify-daily-prices":
        errors = price_capture.verify(spark, a.root, date.fromisoformat(a.date), feeds.read_universe(spark, a.universe), now, a.fail_under)
        _report({"date": a.date, "errors": errors}, a.json_out)
        return 1 if errors else 0
    elif a.command == "market-context":
        made = context.run_context(spark, a.root, date.fromisoformat(a.date), _function(a.fetch), a.run_id, snapshot_run.utc_now(), a.resume)
        print(json.dumps(made, indent=2, sort_keys=True))
        return 0 if made["status"] == "complete" else 1
    elif a.command == "verify-market-context":
        at = Path(a.root) / "_context_manifests" / f"date={a.date}" / "manifest.json"
        errors = context.context_errors(archive, a.date, evidence.read_json(at), Path(a.root) / "_sources") if at.exists() else ["no manifest"]
        _report({"date": a.date, "errors": errors}, a.json_out)
        return 1 if errors else 0
    elif a.command == "build-universe":
        old = feeds.read_universe(spark, a.existing) if a.existing else None
        symbols, funnel = universe.select_symbols(feeds.read_screener(spark, a.screener), old, a.floor)
        feeds.write_universe(symbols, a.out)
        print(json.dumps(funnel.first().asDict()))
    elif a.command == "latest":
        archive.latest_as_of(a.dataset, a.as_of).show(50, False)
    elif a.command in ("seal", "seal-full", "seal-prices"):
        symbols = feeds.read_universe(spark, a.universe)
        try:
            if a.command == "seal-prices":
                made = price_capture.seal(spark, a.root, date.fromisoformat(a.date), symbols, now)
            else:
                made = evidence.seal(archive, a.date, symbols, full=a.command == "seal-full")
        except evidence.SealError as e:
            print(e)
            return 1
        _report({k: made[k] for k in ("date", "generation", "identity_sha256")}, a.json_out)
    elif a.command in PUBLISHED:
        kind = {b.folder: b for b in evidence.BUNDLES.values()}[PUBLISHED[a.command]]
        print(json.dumps(evidence.publish(Path(a.root), a.date, evidence.FolderStore(Path(a.to)), kind, spark)))
    elif a.command == "mirror":
        print(evidence.mirror(Path(a.root), evidence.FolderStore(Path(a.to)), a.date, spark))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
