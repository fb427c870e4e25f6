"""The daily ingest: every symbol's payloads are fetched, parsed and written as they come, failures are tried once more, and a manifest says what happened.

Symbols go through in batches. A batch is fetched in one job (`partitions` tasks; one keeps a vendor's rate limit), materialised, and appended to each
dataset's partition under the batch's own name, so that a batch which is written twice is there once. A dataset that answers with nothing gets a
marker row; a request that failed gets none, is counted as a failure, and only the datasets that are missing are asked for again at the end.

Edge cases: no symbols give a manifest with zeros; a symbol listed twice is fetched once; a null payload is an empty answer; errors lose the secrets in them before they are written.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import UTC, datetime
from itertools import batched
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATASET_CODES
from ..session import materialize
from ..sources.archive import Archive
from ..sources.sinks import complete_symbols, ingest_events, missing_pairs, replace_batch
from ..sources.vendor import redacted
from .coverage import run_counters
from .evidence import write_json
from .normalize import parse_payloads

FETCHED = "symbol string, dataset string, snapshot_utc string, payload string, error string"
#: fetch(symbol, datasets) -> payload by dataset; a dataset that isn't there, or is an exception, failed
Fetch = Callable[[str, Sequence[str]], Mapping[str, object]]


class RunLog:
    """Events of a run, one JSON object a line."""

    def __init__(self, folder: Path | str, run_id: str):
        self.path = Path(folder) / f"{run_id}.jsonl"
        self.path.parent.mkdir(parents=True, exist_ok=True)

    def write(self, event: str, **fields: object) -> None:
        line = {"event": event, "ts": utc_now()} | fields
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(json.dumps(line, default=str, sort_keys=True) + "\n")


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _fetcher(fetch: Fetch):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for symbol, wanted in zip(pdf["symbol"], pdf["datasets"], strict=True):
                try:
                    got = fetch(symbol, list(wanted))
                except Exception as e:  # noqa: BLE001
                    got = dict.fromkeys(wanted, e)
                now, out = utc_now(), []  # known once all requests have come back
                for d in wanted:
                    p = got.get(d, LookupError("no result for the dataset"))
                    failed = isinstance(p, Exception)
                    out.append((symbol, d, now, None if failed or p is None else json.dumps(p, default=str), redacted(str(p)) or type(p).__name__ if failed else None))
                yield pd.DataFrame(out, columns=["symbol", "dataset", "snapshot_utc", "payload", "error"])

    return run


class _Run:
    def __init__(self, spark: SparkSession, root: str, day: str, run_id: str, datasets: Sequence[str], fetch: Fetch, partitions: int, log: RunLog | None):
        self.spark, self.root, self.day, self.run_id, self.datasets, self.fetch, self.partitions, self.log = spark, root, day, run_id, datasets, fetch, partitions, log
        self.counts = {d: {"rows_written": 0, "symbols_no_coverage": 0} for d in datasets}
        self.failures: list[dict] = []
        self.attempted = self.events = 0

    def say(self, event: str, **fields: object) -> None:
        if self.log:
            self.log.write(event, **fields)

    def take(self, wanted: list[tuple[str, list[str]]], name: str, retry: bool) -> list[str]:
        """Fetch and write a batch of (symbol, datasets); the symbols that failed in any."""
        asked = self.spark.createDataFrame(wanted, "symbol string, datasets array<string>").repartition(self.partitions)
        got = materialize(asked.mapInPandas(_fetcher(self.fetch), FETCHED))
        self.attempted += len(wanted)
        bad = [r.asDict() for r in got.where("error is not null").select("symbol", "dataset", "error").orderBy("symbol", "dataset").collect()]  # of one batch
        for f in bad:
            self.failures.append(f | {"retry": retry})
            self.say("dataset_failure", **f, retry=retry)
        for d in self.datasets:
            rows = materialize(parse_payloads(got.where((F.col("dataset") == d) & F.col("error").isNull()), d, self.run_id))
            n = run_counters(rows).first()
            if n is None:
                continue
            replace_batch(rows, self.root, d, self.day, name)
            self.counts[d]["rows_written"] += n["rows_written"]
            self.counts[d]["symbols_no_coverage"] += n["no_coverage"]
            if d == "upgrades_downgrades":
                self.events += ingest_events(self.spark, self.root, rows, self.day)
            self.say("dataset_written", batch=name, dataset=d, rows=n["rows_written"], no_coverage=n["no_coverage"], retry=retry)
        return sorted({f["symbol"] for f in bad})


def run_snapshot(spark: SparkSession, root: str, symbols: DataFrame, fetch: Fetch, day: str, run_id: str, datasets: Sequence[str] = tuple(DATASET_CODES.values()), resume: bool = False, flush_every: int = 50, partitions: int = 1, log: RunLog | None = None) -> dict:
    """Snapshot of one day for symbols(symbol): the manifest, which is also written to _manifests/date=<day>/<run_id>.json."""
    started, archive = utc_now(), Archive(spark, root)
    todo, skipped = symbols.select("symbol").where("symbol is not null").distinct(), 0
    if resume:
        done = complete_symbols(archive, datasets, day)
        skipped = todo.join(done, "symbol", "left_semi").count()
        todo = todo.join(done, "symbol", "left_anti")
    run = _Run(spark, root, day, run_id, datasets, fetch, partitions, log)
    again: list[str] = []
    names = (r.symbol for r in materialize(todo.orderBy("symbol")).toLocalIterator())
    for n, some in enumerate(batched(names, flush_every)):
        again += run.take([(s, list(datasets)) for s in some], f"{run_id}-{n:05d}", False)
    if again:
        run.say("retry_queue_started", symbols=again)
    for n, some in enumerate(batched(again, flush_every)):
        left = missing_pairs(archive, spark.createDataFrame([(s,) for s in some], "symbol string"), datasets, day)
        pairs = left.groupBy("symbol").agg(F.sort_array(F.collect_list("dataset")).alias("d")).orderBy("symbol").collect()  # of one batch
        run.take([(r.symbol, list(r.d)) for r in pairs], f"{run_id}-again-{n:05d}", True)
    manifest = {
        "run_id": run_id, "run_date": day, "started_utc": started, "finished_utc": utc_now(), "spark_version": spark.version, "datasets": {d: c | {"path": f"{root}/{d}/date={day}"} for d, c in run.counts.items()},
        "symbols_attempted": run.attempted, "symbols_skipped_resume": skipped, "symbols_retried": again, "failures": run.failures, "events_added": run.events,
    }
    write_json(Path(root) / "_manifests" / f"date={day}" / f"{run_id}.json", manifest)
    run.say("run_complete", run_id=run_id, run_date=day, symbols_attempted=run.attempted, failures=len(run.failures), events_added=run.events)
    return manifest
