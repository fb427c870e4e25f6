"""Capturing, verifying and sealing the daily bars of one session: batches with checkpoints, a manifest, and proof from what is on disk."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, date, datetime
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import close_utc, is_session, session_axis, sessions_table
from ..schemas import PRICE_ANCHORS, SCHEMAS
from ..sources.archive import Archive, as_utc, exists
from ..sources.sinks import write_partition
from . import asof, prices
from .evidence import LEAST_COVERAGE, PRICE_BUNDLE, SealError, canonical_json, dataset_evidence, file_hashes, identity, partition_files, read_json, schema_hash, table_hash, write_bundle, write_json
from .universe import provider_symbol, requested_symbols

BATCH, TRIES, SCHEMA = 50, 2, "tidemark_prices_v1"
#: fetch(provider symbols, first session, target) -> wide frame with Date and '<ticker>|<field>' columns
Fetch = Callable[[Sequence[str], date, date], pd.DataFrame]


def _utc(t: datetime) -> str:
    return t.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _request(symbols: list[str], axis: list[date], target: date) -> dict:
    return {"symbols": symbols, "sessions": [d.isoformat() for d in axis], "target": target.isoformat(), "batch_size": BATCH, "schema": SCHEMA}


def _download(fetch: Fetch, symbols: Sequence[str], axis: list[date]) -> pd.DataFrame | None:
    for n in range(TRIES):
        try:
            got = fetch(symbols, axis[0], axis[-1])
            return got if got is not None and len(got.columns) > 1 else None
        except Exception:  # noqa: BLE001
            if n + 1 == TRIES:
                return None
    return None


def _rows(spark: SparkSession, wide: pd.DataFrame | None, names: DataFrame, sessions: DataFrame, target: date, stamps: dict) -> tuple[DataFrame, DataFrame]:
    if wide is None:
        return spark.createDataFrame([], SCHEMAS["daily_prices"]), spark.createDataFrame([], "canonical_symbol string, bar_session date, reason string")
    return prices.build_rows(prices.long_bars(spark.createDataFrame(wide)), names, sessions, target, stamps)


def checkpoint_errors(spark: SparkSession, data: str, note: Path, wanted: dict, names: DataFrame, sessions: DataFrame, target: date) -> list[str]:
    """Why a batch's checkpoint can't be taken over; names(symbol, provider_symbol) of the batch.

    Its note must be of the same request, run, batch and provider, its file what the note says, every row must meet the contract, and no symbol may
    lack what it needs to be published: such a batch is fetched again.
    """
    if not note.exists() or not exists(spark, data):
        return ["absent"]
    old, kinds = read_json(note), SCHEMAS["daily_prices"]
    raw = spark.read.parquet(data)
    if {k: old.get(k) for k in wanted} != wanted:
        return ["another request, run, batch or provider"]
    if [(f.name, f.dataType) for f in raw.schema.fields] != [(f.name, f.dataType) for f in kinds.fields] or old.get("schema_sha256") != schema_hash(raw):
        return ["columns"]
    rows = spark.read.schema(kinds).parquet(data)
    if old.get("rows") != rows.count() or old.get("content") != table_hash(rows, ["canonical_symbol", "bar_session"]):
        return ["content"]
    try:
        begun, ended = (_utc(as_utc(old[k])) for k in ("capture_started_utc", "capture_finished_utc"))
    except (KeyError, TypeError, ValueError):
        return ["times"]
    checked = prices.contract_errors(rows, target, _utc(close_utc(target)), ended, (begun, ended))
    checked = checked.join(names.select(F.col("symbol").alias("canonical_symbol"), F.col("provider_symbol").alias("want")), "canonical_symbol", "left")
    checked = checked.join(F.broadcast(sessions.select(F.col("session_date").alias("bar_session"), F.lit(True).alias("on_axis"))), "bar_session", "left")
    same = [("symbol", F.col("canonical_symbol")), ("provider_symbol", F.col("want")), ("target_session", F.lit(target)), ("on_axis", F.lit(True)), *[(k, F.lit(wanted[k])) for k in ("run_id", "batch_id", "provider_version")]]
    off = F.size("errors") > 0
    for name, value in same:
        off = off | ~F.col(name).eqNullSafe(value)
    n_off, n_pairs = checked.agg(F.count_if(off), F.count_distinct("canonical_symbol", "bar_session")).first()
    whole = prices.eligible(rows, sessions, target)
    good = sorted(r[0] for r in whole.collect())  # of one batch
    out = [f"{n_off} rows break the contract"] if n_off else []
    if n_pairs != old["rows"]:
        out.append("repeated rows")
    if not names.join(whole, names["symbol"] == whole["canonical_symbol"], "left_anti").isEmpty():
        out.append("symbols that can't be published")
    if old.get("succeeded") != good or old.get("missing") != sorted(r[0] for r in names.select("symbol").collect() if r[0] not in good):
        out.append("lists of symbols")
    return out


def capture(spark: SparkSession, root: str, universe: DataFrame, target: date, fetch: Fetch, run_id: str, provider_version: str, clock: Callable[[], datetime] = lambda: datetime.now(UTC)) -> dict:
    """Fetch all batches not yet captured, retry incomplete symbols one by one, write the partition and its manifest.

    A batch's checkpoint counts only if checkpoint_errors finds nothing. Each batch is 50 symbols of 30 sessions.
    """
    if not is_session(target) or clock() < close_utc(target):
        raise SealError(f"{target} is no completed session")
    axis, sessions = session_axis(target), sessions_table(spark, session_axis(target)[0], target)
    asked = requested_symbols(universe)
    symbols = [r.symbol for r in asked.collect()]
    started, request = clock(), _request(symbols, axis, target)
    base, failures, parts = f"{root}/_price_checkpoints/date={target}", [], []
    for n in range(0, len(symbols), BATCH):
        batch_id, some = f"batch_{n // BATCH + 1:04d}", symbols[n : n + BATCH]
        note, data = Path(base) / f"{batch_id}.json", f"{base}/{batch_id}"
        mark = {"schema": SCHEMA, "status": "complete", "request": identity(_request(some, axis, target)), "batch_id": batch_id, "run_id": run_id, "provider_version": provider_version}
        names = spark.createDataFrame([(s,) for s in some], "symbol string").withColumn("provider_symbol", provider_symbol(F.col("symbol")))
        if not checkpoint_errors(spark, data, note, mark, names, sessions, target):
            parts.append(data)
            continue
        begun = first = clock()
        wide = _download(fetch, [s.replace(".", "-") for s in some], axis)
        ended = clock()
        stamps = {"run_id": run_id, "provider_version": provider_version, "batch_id": batch_id, "capture_started_utc": _utc(begun), "capture_finished_utc": _utc(ended), "available_at_utc": _utc(ended)}
        rows, _ = _rows(spark, wide, names, sessions, target, stamps)
        whole = {r.canonical_symbol for r in rows.groupBy("canonical_symbol").count().where(F.col("count") == len(axis)).collect()}
        for s in [x for x in some if x not in whole]:
            begun = clock()
            again = _download(fetch, [s.replace(".", "-")], axis)
            ended = clock()
            if again is not None:
                one = stamps | {"capture_started_utc": _utc(begun), "capture_finished_utc": _utc(ended), "available_at_utc": _utc(ended)}
                rows = asof.overlay(rows, _rows(spark, again, names.where(F.col("symbol") == s), sessions, target, one)[0], ["canonical_symbol", "bar_session"])
        rows.select(*SCHEMAS["daily_prices"].fieldNames()).coalesce(1).write.mode("overwrite").parquet(data)
        kept = spark.read.schema(SCHEMAS["daily_prices"]).parquet(data)
        good = sorted(r[0] for r in prices.eligible(kept, sessions, target).collect())
        write_json(note, mark | {
            "rows": kept.count(), "schema_sha256": schema_hash(spark.read.parquet(data)), "content": table_hash(kept, ["canonical_symbol", "bar_session"]), "capture_started_utc": _utc(first), "capture_finished_utc": _utc(ended),
            "succeeded": good, "missing": sorted(s for s in some if s not in good),
        })
        parts.append(data)
    everything = spark.read.schema(SCHEMAS["daily_prices"]).parquet(*parts)
    good = everything.join(prices.eligible(everything, sessions, target), "canonical_symbol", "left_semi").select(*SCHEMAS["daily_prices"].fieldNames())
    write_partition(good.coalesce(1), root, "daily_prices", target.isoformat())
    stored = read_prices(spark, root, target)
    kept = {r.canonical_symbol for r in stored.select("canonical_symbol").distinct().collect()}
    failures = sorted(s for s in symbols if s not in kept)
    anchors_missing = [a for a in PRICE_ANCHORS if a in failures]
    cov = prices.coverage(stored, asked, sessions, target).first().asDict()
    # Batches taken over from an earlier try began before this one
    begun = stored.agg(F.min("capture_started_utc")).first()[0]
    started = min([started, *([as_utc(begun)] if begun else [])])
    manifest = {
        "schema": SCHEMA, "status": "incomplete" if anchors_missing or not kept else "complete", "dataset": "daily_prices", "date": target.isoformat(), "session_close_utc": _utc(close_utc(target)), "started_utc": _utc(started), "finished_utc": _utc(clock()),
        "request": request, "request_sha256": identity(request), "run_id": run_id, "provider_version": provider_version, "failures": failures, "coverage": cov, "output": _output(spark, root, target, stored),
    }
    manifest["identity_sha256"] = identity(manifest)
    write_json(Path(root) / "_price_manifests" / f"date={target}" / "manifest.json", manifest)
    return manifest


def read_prices(spark: SparkSession, root: str, target: date) -> DataFrame:
    return spark.read.schema(SCHEMAS["daily_prices"]).parquet(f"{root}/daily_prices/date={target}")


def _output(spark: SparkSession, root: str, target: date, stored: DataFrame) -> dict:
    files = sorted(p.relative_to(root).as_posix() for p in Path(f"{root}/daily_prices/date={target}").glob("*.parquet"))
    return {"rows": stored.count(), "schema_sha256": schema_hash(stored), "content": table_hash(stored, ["canonical_symbol", "bar_session"]), "files": file_hashes(spark, Path(root), files)}


MANIFEST_KEYS = {"schema", "status", "dataset", "date", "session_close_utc", "started_utc", "finished_utc", "request", "request_sha256", "run_id", "provider_version", "failures", "coverage", "output", "identity_sha256"}


def verify(spark: SparkSession, root: str, target: date, universe: DataFrame, now: datetime, least: float = 0.95) -> list[str]:
    """Everything recomputed from disk and held against the manifest; the list of what is wrong, at most MOST_ERRORS of the rows' errors."""
    at = Path(root) / "_price_manifests" / f"date={target}" / "manifest.json"
    if not 0 <= least <= 1 or not is_session(target) or close_utc(target) > now:
        return ["threshold or session"]
    if not at.exists():
        return ["no manifest"]
    m = read_json(at)
    if set(m) != MANIFEST_KEYS:
        return [f"keys differ: {sorted(set(m) ^ MANIFEST_KEYS)}"]
    out, axis = [], session_axis(target)
    sessions, asked = sessions_table(spark, axis[0], target), requested_symbols(universe)
    request = _request([r.symbol for r in asked.collect()], axis, target)
    for name, ok in {
        "schema": m["schema"] == SCHEMA, "status": m["status"] == "complete", "dataset": m["dataset"] == "daily_prices", "date": m["date"] == target.isoformat(), "close": as_utc(m["session_close_utc"]) == close_utc(target),
        "identity": identity(m) == m["identity_sha256"], "request": canonical_json(m["request"]) == canonical_json(request) and m["request_sha256"] == identity(request), "provider_version": bool(m["provider_version"]),
        "times": close_utc(target) <= as_utc(m["started_utc"]) <= as_utc(m["finished_utc"]) <= now, "failures": m["failures"] == sorted(set(m["failures"])),
    }.items():
        if not ok:
            out.append(name)
    if not exists(spark, f"{root}/daily_prices/date={target}"):
        return [*out, "no partition"]
    raw = spark.read.parquet(f"{root}/daily_prices/date={target}")
    if [(f.name, f.dataType) for f in raw.schema.fields] != [(f.name, f.dataType) for f in SCHEMAS["daily_prices"].fields]:
        return [*out, "columns"]
    stored = read_prices(spark, root, target)
    if _output(spark, root, target, stored) != m["output"]:
        out.append("output")
    names = asked.withColumn("want", provider_symbol(F.col("symbol"))).withColumnRenamed("symbol", "asked")
    joined = stored.join(names, stored.canonical_symbol == names.asked, "left")
    off = joined.agg(
        F.count_if(F.col("asked").isNull()).alias("unknown symbols"), F.count_if(~F.col("symbol").eqNullSafe(F.col("canonical_symbol"))).alias("symbols that aren't canonical"), F.count_if(~F.col("provider_symbol").eqNullSafe(F.col("want"))).alias("provider symbols"),
        F.count_if(~F.col("target_session").eqNullSafe(F.lit(target))).alias("other targets"), F.count_if(~F.coalesce(F.col("bar_session").isin(axis), F.lit(False))).alias("sessions off the axis"),
        (F.count_distinct("run_id") - 1).alias("further runs"), (F.count_distinct("provider_version") - 1).alias("further provider versions"),
    ).first().asDict()
    out += [f"{n} {what}" for what, n in off.items() if n]
    if stored.groupBy("canonical_symbol", "bar_session").count().where("count > 1").limit(1).count():
        out.append("repeated rows")
    numbered = stored.select("canonical_symbol", "bar_session", F.col("_metadata.row_index").alias("row_no"), F.col("_metadata.file_path").alias("file"))
    if not asof.unsorted_rows(numbered, ["canonical_symbol", "bar_session"], "row_no", "file").isEmpty():
        out.append("order of rows")
    checked = prices.contract_errors(stored, target, m["session_close_utc"], _utc(now), (m["started_utc"], m["finished_utc"]))
    out += [r.message for r in prices.error_sample(checked.where(F.size("errors") > 0)).collect()]
    cov = prices.coverage(stored, asked, sessions, target).first().asDict()
    if cov != m["coverage"]:
        out.append("coverage differs from the manifest")
    if cov["ratio"] < least:
        out.append(f"coverage {cov['ratio']:.6f}")
    if cov["anchors_with_full_axis"] != len(PRICE_ANCHORS):
        out.append("anchors are incomplete")
    missing = {r.symbol for r in asked.join(stored.select(F.col("canonical_symbol").alias("symbol")).distinct(), "symbol", "left_anti").collect()}
    if missing != set(m["failures"]):
        out.append("failures differ from missing symbols")
    return out


def seal(spark: SparkSession, root: str, target: date, universe: DataFrame, now: datetime, producer: dict | None = None) -> dict:
    """Verify again and seal the price partition and its manifest as a bundle of their own, beside any other of the day; `evidence.publish` with PRICE_BUNDLE takes it from there."""
    if errors := verify(spark, root, target, universe, now):
        raise SealError("; ".join(errors[:20]))
    base, day = Path(root), target.isoformat()
    e = dataset_evidence(Archive(spark, root), "daily_prices", day, None)
    paths = [p for p in partition_files(base, day) if Path(p).parts[0] in ("daily_prices", "_price_manifests")]
    return write_bundle(spark, base, PRICE_BUNDLE, day, [e], paths, now, LEAST_COVERAGE, producer)
