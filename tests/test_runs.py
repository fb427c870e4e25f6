"""The ingest loop, market-context capture, full seal, and what happens when a write fails half-way."""

import io
import zipfile
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.operators import context, evidence, snapshot_run
from tidemark.sources import feeds, sinks
from tidemark.sources.archive import Archive

DATASETS = ["recommendations", "upgrades_downgrades", "estimates"]


def test_run_with_failures_markers_retry_and_resume(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def fetch(symbol, datasets):
        n = len(list(calls.glob(f"{symbol}-*")))
        (calls / f"{symbol}-{n}-{'+'.join(datasets)}").touch()
        if symbol == "DOWN":
            raise RuntimeError("GET https://x/?token=abc123&y=1 failed")
        out = {
            "recommendations": [{"period": "0m", "buy": 3.0}, {"period": "-1m", "buy": 2.0}] if symbol != "BARE" else [],
            "upgrades_downgrades": [{"GradeDate": "2026-06-01T10:00:00", "Firm": f"F {symbol}", "ToGrade": "Buy", "Action": "up"}] if symbol != "BARE" else None,
            "estimates": {"earnings_estimate": [{"period": "0q", "avg": 1.5}]} if symbol != "BARE" else {},
        }
        if symbol == "FLAKY" and n == 0:
            out["estimates"] = ValueError("HTTP 429")
            del out["recommendations"]
        return {d: out[d] for d in datasets if d in out}

    symbols = spark.createDataFrame([("AAPL",), ("BARE",), ("FLAKY",), ("DOWN",), ("AAPL",), (None,)], "symbol string")
    root, day = str(tmp_path / "a"), "2026-08-27"
    log = snapshot_run.RunLog(tmp_path / "logs", "r1")
    m = snapshot_run.run_snapshot(spark, root, symbols, fetch, day, "r1", DATASETS, flush_every=3, log=log)
    a = Archive(spark, root)
    rows = {(r.symbol, r.period): r for r in a.load("recommendations", drop_no_coverage=False).collect()}
    assert {k for k in rows if not rows[k].no_analyst_coverage} == {("AAPL", "0m"), ("AAPL", "-1m"), ("FLAKY", "0m"), ("FLAKY", "-1m")} and rows["BARE", None].no_analyst_coverage
    assert m["symbols_attempted"] == 6 and m["symbols_retried"] == ["DOWN", "FLAKY"] and m["events_added"] == 2 and m["datasets"]["recommendations"] == {"rows_written": 5, "symbols_no_coverage": 1, "path": f"{root}/recommendations/date={day}"}
    assert sorted((f["symbol"], f["dataset"], f["retry"]) for f in m["failures"]) == sorted([("FLAKY", "recommendations", False), ("FLAKY", "estimates", False), *[("DOWN", d, r) for d in DATASETS for r in (False, True)]])
    assert not any("abc123" in f["error"] for f in m["failures"]) and (calls / "FLAKY-1-estimates+recommendations").exists()
    assert evidence.read_json(tmp_path / "a" / "_manifests" / f"date={day}" / "r1.json") == m
    failed = {r.symbol for r in feeds.recent_failures(spark, str(tmp_path / "logs")).collect()}
    assert failed == {"DOWN", "FLAKY"} and '"event": "run_complete"' in log.path.read_text()
    again = snapshot_run.run_snapshot(spark, root, symbols.where("symbol <> 'DOWN'"), fetch, day, "r2", DATASETS, resume=True)
    assert again["symbols_skipped_resume"] == 3 and again["symbols_attempted"] == 0 and a.load("recommendations").count() == 4


def test_a_batch_written_twice_is_there_once(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "symbol string, buy double")
    for _ in range(2):
        sinks.replace_batch(df, str(tmp_path), "recommendations", "2026-08-27", "b1")
    sinks.replace_batch(df.where("symbol = 'A'"), str(tmp_path), "recommendations", "2026-08-27", "b2")
    assert Archive(spark, str(tmp_path)).load("recommendations").count() == 3


def test_a_failed_rename_leaves_the_old_partition(spark, tmp_path, monkeypatch):
    old, new = (spark.createDataFrame([(s, 1.0)], "symbol string, buy double") for s in ("OLD", "NEW"))
    held = lambda: [r.symbol for r in Archive(spark, str(tmp_path)).load("recommendations").collect()]
    sinks.write_partition(old, str(tmp_path), "recommendations", "2026-08-27")
    target = tmp_path / "recommendations" / "date=2026-08-27"
    with pytest.raises(OSError, match="could not move"):
        sinks.swap_in(spark, str(tmp_path / "absent"), str(target))
    assert held() == ["OLD"]
    # A crash between the two renames: the old folder stands aside, no new one is there; the next write begins by bringing it back
    target.rename(sinks._aside(str(target)))
    sinks.recover(spark, str(target))
    assert held() == ["OLD"]
    sinks.write_partition(new, str(tmp_path), "recommendations", "2026-08-27")
    assert held() == ["NEW"] and not list((tmp_path / "recommendations").glob("_replaced*"))


def test_a_crash_between_partition_and_index_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    rows = [("A", "2026-06-01T10:00:00", "F", "Buy", "2026-08-27T21:00:00Z"), ("B", "2026-06-02T10:00:00", "F", "Buy", "2026-08-27T21:00:00Z")]
    df = spark.createDataFrame(rows, "symbol string, GradeDate string, Firm string, ToGrade string, snapshot_utc string")
    done = sinks.replace_batch
    with monkeypatch.context() as m:
        m.setattr(sinks, "replace_batch", lambda *a: (done(*a), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            sinks.ingest_events(spark, str(tmp_path), df, "2026-08-27")
    a = Archive(spark, str(tmp_path))
    assert a.index().count() == 0
    assert sinks.ingest_events(spark, str(tmp_path), df, "2026-08-27") == 2
    assert a.index().count() == 2 and a.load("rating_events").count() == 2
    assert sinks.ingest_events(spark, str(tmp_path), df, "2026-08-28") == 0


def test_seal_sees_columns_that_are_missing_or_of_another_type(spark, tmp_path):
    day, at = "2026-08-27", "2026-08-27T20:30:00Z"
    exp, now = spark.createDataFrame([("AAPL",)], "symbol string"), datetime(2026, 8, 27, 22, tzinfo=UTC)
    good = sinks.conform(spark.createDataFrame([("AAPL", at, "recommendations", 1.0)], "symbol string, snapshot_utc string, dataset string, buy double"), "recommendations")
    a, path = Archive(spark, str(tmp_path)), f"{tmp_path}/recommendations/date={day}"
    for bad in (good.drop("hold"), good.withColumn("hold", F.lit("x"))):
        bad.write.mode("overwrite").parquet(path)
        with pytest.raises(evidence.SealError, match="hold"):
            evidence.seal(a, day, exp, ["recommendations"], now)
    good.write.mode("overwrite").parquet(path)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        made = evidence.seal(a, day, exp, ["recommendations"], now)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert made["datasets"][0]["first_known_utc"] == "2026-08-27T20:30:00Z"
    with pytest.raises(evidence.SealError, match="no manifest"):
        evidence.seal(a, day, exp, ["recommendations"], now, full=True)
    full = made | {"schema": evidence.FULL_BUNDLE.schema}
    assert "datasets are missing" in evidence.rule_errors(full, evidence.FULL_BUNDLE) and "0 files of role run manifest" in evidence.rule_errors(full, evidence.FULL_BUNDLE)
    prices = made | {"schema": evidence.PRICE_BUNDLE.schema}
    assert "files that are no prices" in evidence.rule_errors(prices, evidence.PRICE_BUNDLE)


def _sources(day):
    def fetch(dataset, asked, symbol):
        if dataset == "cftc_tff_positioning":
            if asked.year == day.year:
                raise feeds.NotPublished("not yet")
            head = ["Market_and_Exchange_Names", "Report_Date_as_YYYY-MM-DD", "CFTC_Contract_Market_Code", *feeds.CFTC_HEADERS.values()]
            lines = [",".join(head), *[",".join(["x", "2025-12-30", c, *["10"] * 15]) for c in feeds.CFTC_CONTRACTS]]
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w") as z:
                z.writestr("FinFut.txt", "\n".join(lines))
            return "https://c", buf.getvalue()
        if asked > date(2026, 1, 6):
            raise feeds.NotPublished("weekend")
        if dataset == "finra_short_volume":
            rows = [f"20260106|{s}|5|1|10|Q" for s in ("QQQ", "SPY", *[f"A{i}" for i in range(1000)])]
            return "https://f", ("|".join(feeds.FINRA_HEADER) + "\n" + "\n".join(rows) + "\n").encode()
        rows = [f"1,{symbol},{symbol},{a},{p},CBOE,01/06/2026" for a in "CFM" for p in "CP"]
        return f"https://o/{symbol}", (",".join(feeds.OCC_HEADER) + "\n" + "\n".join(rows) + "\n").encode()

    return fetch


def test_market_context_looks_back_and_verifies(spark, tmp_path):
    day = date(2026, 1, 8)
    fetch = _sources(day)
    m = context.run_context(spark, str(tmp_path), day, fetch, "r", "2026-01-08T22:00:00Z")
    assert m["status"] == "complete" and {d: e["rows"] for d, e in m["datasets"].items()} == {"cftc_tff_positioning": 2, "finra_short_volume": 1002, "occ_account_volume": 12}
    assert context.context_errors(Archive(spark, str(tmp_path)), day.isoformat(), m, tmp_path / "_sources") == []
    with pytest.raises(FileExistsError):
        context.run_context(spark, str(tmp_path), day, fetch, "r", "2026-01-08T22:00:00Z")
    never = lambda *a: 1 / 0
    assert context.run_context(spark, str(tmp_path), day, never, "r", "2026-01-08T22:00:00Z", resume=True) == m
    source = tmp_path / "_sources" / m["datasets"]["finra_short_volume"]["captures"][0]["path"]
    source.write_bytes(evidence.gzip.compress(b"other"))
    broken = context.run_context(spark, str(tmp_path), day, lambda d, *a: fetch(d, *a) if d != "occ_account_volume" else 1 / 0, "r2", "2026-01-08T22:00:00Z", resume=True)
    assert broken["status"] == "partial" and list(broken["errors"]) == ["occ_account_volume"] and broken["datasets"]["finra_short_volume"]["status"] == "ok"


def test_commands_are_there():
    names = cli.parser()._subparsers._group_actions[0].choices
    assert {"run", "daily-prices", "verify-daily-prices", "market-context", "verify-market-context", "seal-full", "seal-prices", "publish-prices", "mirror"} <= set(names)
