"""Capture and verification of market-context partitions: one aggregate row per dataset, then plain rules."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import utc_day
from ..session import materialize
from ..sources import feeds
from ..sources.archive import Archive
from ..sources.feeds import LAG_LIMITS
from ..sources.sinks import write_partition
from ..sources.vendor import redacted
from .evidence import capture, capture_intact, read_json, write_atomic, write_json

SCOPE = {"cftc_tff_positioning": ("exactly", {"NASDAQ100", "SP500"}), "finra_short_volume": ("at least", {"QQQ", "SPY"}), "occ_account_volume": ("exactly", {"QQQ", "SPY"})}


def context_stats(archive: Archive, dataset: str, day: str) -> dict:
    """Counts and small sets of one partition. Symbols are compared with the scope inside the aggregate; at most the scope's names come back."""
    df = archive.load(dataset, day, day, drop_no_coverage=False)
    wanted = sorted(SCOPE[dataset][1])
    aggs = [
        F.count("*").alias("rows"), F.count_if(~F.col("dataset").eqNullSafe(F.lit(dataset))).alias("foreign"), F.count_distinct("source_date").alias("dates"), F.min("source_date").alias("source_date"), F.count_distinct("snapshot_utc").alias("captures"),
        F.min("source_lag_days").alias("lag"), F.max("source_lag_days").alias("lag_max"), F.min(F.datediff(F.lit(day).cast("date"), utc_day("source_date"))).alias("true_lag"),
        F.collect_set(F.when(F.col("symbol").isin(*wanted), F.col("symbol"))).alias("symbols"), F.count_if(~F.coalesce(F.col("symbol").isin(*wanted), F.lit(False))).alias("others"), F.collect_set("source_sha256").alias("hashes"),
    ]
    if dataset == "occ_account_volume":
        aggs += [F.collect_set("account_type_code").alias("accounts"), F.collect_set("call_put_code").alias("sides")]
    return df.agg(*aggs).first().asDict()


def context_errors(archive: Archive, day: str, manifest: dict, sources: Path | None = None) -> list[str]:
    """What is wrong with a day's market context; manifest: {"status", "errors", "datasets": {name: {"status", "rows", "captures": [...]}}}."""
    out = []
    if manifest.get("status") != "complete" or manifest.get("errors"):
        out.append("manifest is not complete")
    for dataset, (mode, wanted) in SCOPE.items():
        entry = manifest.get("datasets", {}).get(dataset, {})
        if entry.get("status") != "ok":
            out.append(f"{dataset}: status")
            continue
        s = context_stats(archive, dataset, day)
        if not s["rows"] or s["rows"] != entry.get("rows"):
            out.append(f"{dataset}: {s['rows']} rows, manifest {entry.get('rows')}")
            continue
        if s["foreign"]:
            out.append(f"{dataset}: rows of another dataset")
        if s["dates"] != 1 or s["captures"] != 1:
            out.append(f"{dataset}: source date or capture time is not uniform")
        if s["lag"] is None or s["lag"] != s["lag_max"] or s["lag"] != s["true_lag"] or not 0 <= s["lag"] <= LAG_LIMITS[dataset]:
            out.append(f"{dataset}: lag {s['lag']}")
        if set(s["symbols"]) != wanted or (mode == "exactly" and s["others"]):
            out.append(f"{dataset}: symbols")
        if dataset == "occ_account_volume" and (set(s["accounts"]) != {"C", "F", "M"} or set(s["sides"]) != {"C", "P"}):
            out.append(f"{dataset}: accounts or sides")
        if set(s["hashes"]) != {c["source_sha256"] for c in entry.get("captures", [])}:
            out.append(f"{dataset}: source hashes")
        if sources and not all(capture_intact(sources, c) for c in entry.get("captures", [])):
            out.append(f"{dataset}: capture changed")
    return out


def _read(spark: SparkSession, dataset: str, paths: list[tuple[str, str, str]], run_date: date, snapshot_utc: str, run_id: str) -> DataFrame:
    """paths: (file, url, symbol) of one dataset's sources."""
    frames = []
    for path, url, symbol in paths:
        if dataset == "cftc_tff_positioning":
            frames.append(feeds.read_cftc(spark, path, run_date, snapshot_utc, run_id, url))
        elif dataset == "finra_short_volume":
            frames.append(feeds.read_finra(spark, path, run_date, snapshot_utc, run_id, url))
        else:
            frames.append(feeds.read_occ(spark, path, symbol, run_date, snapshot_utc, run_id, url))
    return reduce(DataFrame.unionByName, frames)


def run_context(spark: SparkSession, root: str, run_date: date, fetch: Callable[[str, date, str], tuple[str, bytes]], run_id: str, snapshot_utc: str, resume: bool = False, lookback: int = 7) -> dict:
    """Capture, read and write the day's market feeds; the manifest, which is also written to _context_manifests.

    fetch(dataset, date, symbol) -> (url, bytes); it raises feeds.NotPublished for a date the feed doesn't have. FINRA and OCC are asked for the run's date and
    up to `lookback` days before, and must hold the date asked for, OCC for all its symbols; CFTC is asked for this year's file, then last year's. A feed that
    fails doesn't keep the others: the manifest is then partial. A day already captured is an error, or with `resume` taken over if it still verifies.
    """
    day, base = run_date.isoformat(), Path(root)
    note, archive = base / "_context_manifests" / f"date={day}" / "manifest.json", Archive(spark, root)
    if note.exists():
        if not resume:
            raise FileExistsError(f"{day} is captured already")
        if not context_errors(archive, day, old := read_json(note), base / "_sources"):
            return old
    entries, errors = {}, {}
    for dataset, (_, wanted) in SCOPE.items():
        names = sorted(wanted) if dataset == "occ_account_volume" else [""]

        def read(asked: date, dataset=dataset, names=names) -> tuple[DataFrame, list[dict]]:
            paths, captures = [], []
            for symbol in names:
                url, content = fetch(dataset, asked, symbol)
                name = "-".join(x for x in (dataset, symbol, asked.isoformat()) if x)
                raw = base / "_staging" / "context" / (name + (".zip" if dataset == "cftc_tff_positioning" else ".txt"))
                write_atomic(raw, content)
                paths.append((str(raw), url, symbol))
                captures.append((name, url, content))
            df = materialize(_read(spark, dataset, paths, run_date, snapshot_utc, run_id))
            if dataset != "cftc_tff_positioning" and [r[0] for r in df.select("source_date").distinct().limit(2).collect()] != [asked.isoformat()]:
                raise feeds.FeedError(f"{dataset} holds another date than {asked}")
            kept = [capture(base / "_sources" / dataset / f"date={day}", n, c) | {"url": u} for n, u, c in captures]
            return df, [c | {"path": f"{dataset}/date={day}/{c['path']}"} for c in kept]

        try:
            if dataset == "cftc_tff_positioning":
                (df, captures), _ = feeds.newest_of(read, [run_date, date(run_date.year - 1, 12, 31)])
            else:
                (df, captures), _ = feeds.newest_available(read, run_date, lookback)
            write_partition(df, root, dataset, day)
            entries[dataset] = {"status": "ok", "rows": df.count(), "captures": captures}
        except Exception as e:  # noqa: BLE001
            errors[dataset] = redacted(str(e))
            entries[dataset] = {"status": "error", "rows": 0, "captures": []}
    manifest = {"date": day, "run_id": run_id, "snapshot_utc": snapshot_utc, "status": "partial" if errors else "complete", "errors": errors, "datasets": entries}
    write_json(note, manifest)
    return manifest
