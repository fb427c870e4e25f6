"""Scans, sinks, events, feeds, prices, calendar, coverage, evidence, streaming on tiny archives made here."""

import io
import json
import zipfile
from datetime import UTC, date, datetime
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark.functions import calendar
from tidemark.operators import coverage, evidence, normalize, prices, universe
from tidemark.operators.context import context_errors
from tidemark.schemas import PRICE_ANCHORS, SCHEMAS, dataset_codes
from tidemark.sources import feeds, sinks, vendor
from tidemark.sources.archive import Archive
from tidemark.streaming import ingest


def write(spark, root, dataset, day, rows, **types):
    names = list(dict.fromkeys(k for r in rows for k in r))
    kinds = {"no_analyst_coverage": "boolean", "buy": "double", **types}
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` {kinds.get(n, 'string')}" for n in names))
    sinks.write_partition(df, str(root), dataset, day)


@pytest.fixture
def archive(spark, tmp_path):
    base = lambda s, at, **k: {"symbol": s, "snapshot_utc": at, "dataset": "recommendations", "run_id": "r", "period": "0m", **k}
    write(spark, tmp_path, "recommendations", "2026-07-02", [base("AAPL", "2026-07-03T02:05:00Z", buy=10.0), base("MSFT", "2026-07-03T02:06:00Z", buy=20.0)])
    write(spark, tmp_path, "recommendations", "2026-07-03", [base("AAPL", "2026-07-04T02:05:00Z", buy=11.0), base("MSFT", "2026-07-04T02:06:00Z", no_analyst_coverage=True)])
    return Archive(spark, str(tmp_path))


def values(df):
    return {(r.symbol, r.trading_date, r.buy) for r in df.collect()}


def test_load(archive):
    assert archive.load("recommendations").count() == 3
    assert archive.load("recommendations", drop_no_coverage=False).count() == 4
    assert values(archive.load("recommendations", as_of="2026-07-03T20:00:00Z")) == {("AAPL", "2026-07-02", 10.0), ("MSFT", "2026-07-02", 20.0)}
    assert archive.load("recommendations", start="2026-07-03", end="2026-07-03").count() == 1
    assert archive.load("recommendations", symbols=[]).count() == 0
    assert archive.load("recommendations", symbols=["MSFT"]).count() == 1
    assert set(archive.load("recommendations", columns=["buy", "unknown"]).columns) == {"symbol", "snapshot_utc", "no_analyst_coverage", "buy", "trading_date", "snapshot_ts"}
    assert archive.load("profile").count() == 0 and "snapshot_ts" in archive.load("profile").columns
    assert archive.dates("recommendations") == ["2026-07-02", "2026-07-03"] and archive.previous_date("2026-07-03") == "2026-07-02"
    assert {r.trading_date: r.symbols for r in archive.universe_by_date("recommendations").collect()} == {"2026-07-02": ["AAPL", "MSFT"], "2026-07-03": ["AAPL", "MSFT"]}
    got = {r.dataset: (r.partitions, r.first_date) for r in archive.summary().collect()}
    assert got["recommendations"] == (2, "2026-07-02") and got["estimates"] == (0, None)


def test_latest_as_of(archive):
    at = lambda t: values(archive.latest_as_of("recommendations", t, group_extra=["period"]))
    assert at("2026-07-04T12:00:00Z") == {("AAPL", "2026-07-03", 11.0), ("MSFT", "2026-07-02", 20.0)}
    assert at("2026-07-03T12:00:00Z") == {("AAPL", "2026-07-02", 10.0), ("MSFT", "2026-07-02", 20.0)}
    assert at("2026-07-01T12:00:00Z") == set()


def test_scan_plan_prunes_and_pushes(archive):
    plan = archive.load("recommendations", start="2026-07-03", symbols=["AAPL"], columns=["buy"])._jdf.queryExecution().toString()
    assert "strongBuy" not in plan.split("Physical Plan")[1].split("ReadSchema")[1].split("\n")[0] and "AAPL" in plan.split("PushedFilters")[1]


def test_vintages_read_together(spark, tmp_path):
    spark.conf.set("spark.sql.caseSensitive", "true")
    row = ("AAPL", "2026-06-02T00:00:00Z", "2026-06-01T10:00:00", "Old Vintage", "Old Vintage", None)
    old = spark.createDataFrame([row], "symbol string, snapshot_utc string, GradeDate string, Firm string, firm string, event_utc string")
    old.write.parquet(f"{tmp_path}/upgrades_downgrades/date=2026-06-01")
    spark.createDataFrame([("AAPL", "2026-08-02T00:00:00Z", "2026-08-01T10:00:00", "New Vintage", "x")], "symbol string, snapshot_utc string, event_utc string, firm string, extra string").write.parquet(f"{tmp_path}/upgrades_downgrades/date=2026-08-01")
    spark.createDataFrame([("AAPL", 1.0, "abc")], "symbol string, `7daysago` double, avg string").write.parquet(f"{tmp_path}/estimates/date=2026-08-01")
    spark.createDataFrame([("AAPL", 2.0, 3.0, None)], "symbol string, `7daysago` double, avg double, `7daysAgo` double").write.parquet(f"{tmp_path}/estimates/date=2026-08-02")
    spark.conf.set("spark.sql.caseSensitive", "false")
    a = Archive(spark, str(tmp_path))
    got = sorted((r.firm, r.event_utc, r.event_date) for r in a.load("upgrades_downgrades").collect())
    assert got == [("New Vintage", "2026-08-01T10:00:00", "2026-08-01"), ("Old Vintage", "2026-06-01T10:00:00", "2026-06-01")]
    est = sorted((r.trading_date, r["7daysAgo"], r.avg) for r in a.load("estimates").collect())
    assert est == [("2026-08-01", 1.0, None), ("2026-08-02", 2.0, 3.0)]


def event(symbol="AAPL", at="2026-06-01T10:00:00", seen="2026-07-02T12:00:00Z", **k):
    return {"symbol": symbol, "snapshot_utc": seen, "GradeDate": at, "Firm": "F", "FromGrade": None, "ToGrade": "Buy", "Action": "up", **k}


def frame(spark, rows):
    names = list(rows[0])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def test_events_first_seen_compact_rebuild(spark, tmp_path):
    root = str(tmp_path)
    assert sinks.ingest_events(spark, root, frame(spark, [event(), event(), event(at=" "), event(at=None)]), "2026-07-01") == 1
    assert sinks.ingest_events(spark, root, frame(spark, [event(seen="2026-08-02T12:00:00Z")]), "2026-08-01") == 0
    assert sinks.ingest_events(spark, root, frame(spark, [event(FromGrade="Hold", seen="2026-08-02T12:00:00Z")]), "2026-08-01") == 1
    a = Archive(spark, root)
    assert "snapshot_utc" not in a.index().columns and a.index().count() == 2
    assert a.load_events(as_of="2026-07-03").count() == 1 and a.load_events(start="2026-06-02").count() == 0 and a.load_events(use_index=False).count() == 2
    a.index().write.mode("append").parquet(f"{root}/_index/rating_events")
    assert sinks.compact_events(spark, root) == 2 and Archive(spark, root).index().count() == 2
    got = sinks.rebuild_events(spark, root)
    assert got["partitions"] == 2 and got["events_after"] == 2
    assert sorted(r.first_seen_utc for r in Archive(spark, root).index().collect()) == ["2026-07-02T12:00:00Z", "2026-08-02T12:00:00Z"]


def test_compact_refuses_keys_without_time(spark, tmp_path):
    spark.createDataFrame([("A", None)], "symbol string, event_utc string").write.parquet(f"{tmp_path}/_index/rating_events")
    with pytest.raises(ValueError):
        sinks.compact_events(spark, str(tmp_path))


def test_conform_keeps_types_and_lost_text(spark, tmp_path):
    df = spark.createDataFrame([("A", "8.5", "zz"), ("B", "Infinity", None), ("C", "n/a?", None)], "symbol string, buy string, zeta string")
    out = sinks.conform(df, "recommendations")
    assert out.columns[: len(SCHEMAS["recommendations"])] == SCHEMAS["recommendations"].fieldNames() and dict(out.dtypes)["buy"] == "double"
    assert [(r.symbol, r.buy, r.buy__raw) for r in out.orderBy("symbol").collect()] == [("A", 8.5, None), ("B", None, None), ("C", None, "n/a?")]
    assert "buy__raw" not in sinks.drop_empty_raw(out.where("symbol <> 'C'")).columns


def test_failed_write_keeps_the_old_partition(spark, archive):
    bad = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("symbol"))
    with pytest.raises(Exception, match="no"):
        sinks.write_partition(bad, archive.root, "recommendations", "2026-07-02")
    assert archive.load("recommendations", "2026-07-02", "2026-07-02").count() == 2


def test_writer_and_resume(spark, tmp_path):
    w = sinks.SnapshotWriter(spark, str(tmp_path), "2026-07-02", "run1", every=2)
    for s in ("A", "B", "C"):
        w.add("recommendations", [{"symbol": s, "snapshot_utc": "2026-07-03T00:00:00Z", "buy": 1.5}])
        w.add("profile", [{"symbol": s, "snapshot_utc": "2026-07-03T00:00:00Z"}] if s != "C" else [])
        w.add_rating_events([{"symbol": s, "GradeDate": "2026-06-01T10:00:00", "Firm": "F"}, {"symbol": s, "no_analyst_coverage": True}], "2026-07-03T00:00:00Z")
        w.symbol_done()
    w.flush()
    a = Archive(spark, str(tmp_path))
    assert w.events_added == a.index().count() == 3 and w.known_symbols("profile").count() == 2
    assert a.load("recommendations").count() == 3 and {r.run_id for r in a.load("recommendations").collect()} == {"run1"}
    assert {r.symbol for r in sinks.complete_symbols(a, ["recommendations", "profile"], "2026-07-02").collect()} == {"A", "B"}
    asked = spark.createDataFrame([("A",), ("C",), ("D",)], "symbol string")
    assert {tuple(r) for r in sinks.missing_pairs(a, asked, ["recommendations", "profile"], "2026-07-02").collect()} == {("C", "profile"), ("D", "profile"), ("D", "recommendations")}


def test_payloads(spark):
    rows = [("AAPL", "t", json.dumps([{"period": "0m", "strongBuy": 3, "Surprise(%)": 1.5, "odd": [None, "a", "b"]}])), ("MSFT", "t", "[]"), ("X", "t", None), ("Y", "t", "not json")]
    out = {r.symbol: r for r in normalize.parse_payloads(spark.createDataFrame(rows, "symbol string, snapshot_utc string, payload string"), "recommendations", "r").collect()}
    assert out["AAPL"].strongBuy == 3.0 and out["AAPL"].extras == {"surprise_pct": "1.5", "odd": "a, b"} and out["AAPL"].no_analyst_coverage is None
    assert all(out[s].no_analyst_coverage for s in ("MSFT", "X", "Y"))
    est = [("AAPL", "t", json.dumps({"eps_trend": [{"period": "0q", "7daysAgo": 1.25}], "eps_revisions": [{"period": "0q", "downLast7days": 2}]}))]
    got = {r.estimate_table: r for r in normalize.parse_payloads(spark.createDataFrame(est, "symbol string, snapshot_utc string, payload string"), "estimates", "r").collect()}
    assert got["eps_trend"]["7daysAgo"] == 1.25 and got["eps_revisions"]["downLast7Days"] == 2.0
    ev = [("AAPL", "t", json.dumps([{"GradeDate": "2026-06-01T00:00:00", "Firm": "F", "ToGrade": "Buy", "Action": "up", "currentPriceTarget": 5}]))]
    r = normalize.parse_payloads(spark.createDataFrame(ev, "symbol string, snapshot_utc string, payload string"), "upgrades_downgrades", "r").first()
    assert (r.event_utc, r.event_date, r.firm, r.currentPriceTarget) == ("2026-06-01", "2026-06-01", "F", 5.0)
    assert normalize.usable_name("EPS Estimate") == "EPS_Estimate".lower() and normalize.usable_name("pctHeld") == "pctHeld" and normalize.usable_name("!!") == "unnamed"
    assert normalize.clean(["2026-10-29 00:00:00", "2026-11-02T00:00:00"]) == "2026-10-29, 2026-11-02"
    shares = normalize.payload_rows("shares_outstanding", {"2026-01-01T00:00:00": 5.0})
    assert shares == [{"as_of_date": "2026-01-01", "shares_outstanding": 5.0}]
    assert dataset_codes("a, b") == ["recommendations", "analyst_price_targets"]
    with pytest.raises(ValueError):
        dataset_codes("z")


def test_universe(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"data": {"table": {"rows": [{"symbol": "AAPL", "name": "Apple Inc.", "marketCap": "3,000,000,000"}, {"symbol": "BRK/B", "name": "Berkshire", "marketCap": "$500,000,000"}, {"symbol": "TINY", "name": "Tiny", "marketCap": "5"}, {"symbol": "W", "name": "Some Warrants", "marketCap": "900,000,000"}, {"symbol": "P^A", "name": "Pref", "marketCap": "900,000,000"}]}}}))
    rows = feeds.read_screener(spark, str(tmp_path / "s.json"))
    old = spark.createDataFrame([("GONE",), ("TINY",), ("AAPL",)], "symbol string")
    symbols, funnel = universe.select_symbols(rows, old)
    assert [r.symbol for r in symbols.collect()] == ["AAPL", "BRK-B", "GONE", "TINY"]
    assert funnel.first().asDict() == {"listings": 5, "after_security_filter": 3, "after_market_cap_filter": 2, "carried_over": 2, "total": 4}
    (tmp_path / "u.txt").write_text(" msft\n# no\n\naapl\nMSFT\n")
    assert [r.symbol for r in feeds.read_universe(spark, str(tmp_path / "u.txt")).collect()] == ["MSFT", "AAPL"]
    assert universe.requested_symbols(old).count() == 3 + len(PRICE_ANCHORS)
    (tmp_path / "l.json").write_text(json.dumps([{"symbol": "X", "name": "n", "marketCap": None}]))
    assert feeds.read_screener(spark, str(tmp_path / "l.json")).count() == 1


def test_calendar():
    assert not calendar.is_session(date(2026, 7, 3)) and not calendar.is_session(date(2026, 11, 26)) and not calendar.is_session(date(2026, 4, 3))
    closes = {date(2026, 8, 27): 20, date(2026, 1, 8): 21, date(2026, 11, 27): 18}
    assert all(calendar.close_utc(d).hour == h for d, h in closes.items())
    assert calendar.session_axis(date(2026, 8, 27))[0] == date(2026, 7, 17) and calendar.session_axis(date(2026, 11, 27))[0] == date(2026, 10, 16) and len(calendar.session_axis(date(2026, 11, 27))) == 30
    at = lambda h, m=0: datetime(2026, 8, 27, h, m, tzinfo=UTC)
    assert [calendar.latest_completed(at(4, 1)), calendar.latest_completed(at(13)), calendar.latest_completed(at(21))] == [date(2026, 8, 26), date(2026, 8, 26), date(2026, 8, 27)]
    assert calendar.completed_session(date(2026, 7, 3), at(21))["reason"] == "requested_date_was_not_trading_session"
    assert calendar.completed_session(date(2026, 8, 27), at(19))["reason"] == "requested_session_has_not_closed" and calendar.completed_session(None, at(21))["run"]
    gate = lambda e, c, now: calendar.schedule_gate(e, c, now)["reason"]
    assert gate("workflow_dispatch", None, at(1)) == "manual_dispatch" and gate("push", None, at(1)) == "unsupported_event" and gate("schedule", "0 * * * *", at(1)) == "unknown_schedule"
    assert gate("schedule", "30 17 * * 1-5", at(23)) == "authorized_new_york_weekday_schedule" and gate("schedule", "0 9 * * 1-5", at(23)) == "schedule_before_session_close"
    assert gate("schedule", "30 17 * * 1-5", datetime(2026, 7, 3, 23, tzinfo=UTC)) == "new_york_date_was_not_trading_session"
    assert calendar.should_run(date(2026, 7, 3))["run"] is False and calendar.should_run(date(2026, 7, 3), force=True)["reason"] == "forced" and calendar.should_run(date(2026, 7, 3), offset_days=1)["run"]
    assert cli.main(["schedule-gate", "--event", "push"]) == 2 and cli.main(["should-run", "--date", "2026-08-27"]) == 0


TARGET = date(2026, 8, 27)
STAMPS = {"run_id": "r", "provider_version": "1", "capture_started_utc": "2026-08-27T20:01:00Z", "capture_finished_utc": "2026-08-27T20:02:00Z", "available_at_utc": "2026-08-27T20:02:00Z", "batch_id": "batch_0001"}
BAR = "provider_symbol string, bar_session date, open double, high double, low double, close double, adj_close double, volume double, dividend_cash double, stock_split_ratio double"


def _bars(spark, bars):
    sessions = calendar.sessions_table(spark, date(2026, 7, 17), TARGET)
    symbols = spark.createDataFrame([("AAPL", "AAPL"), ("BRK.B", "BRK-B"), ("QQQ", "QQQ")], "symbol string, provider_symbol string")
    rows, bad = prices.build_rows(spark.createDataFrame(bars, BAR), symbols, sessions, TARGET, STAMPS)
    return rows, bad, sessions, symbols


def test_prices(spark):
    bars = [
        ("AAPL", TARGET, 1.00, 1.01, 0.99, 1.01, 0.8585, 10.0, 0.0, 0.0), ("BRK-B", TARGET, 1.055, 1.06, 1.05, 1.05, 0.8505, 10.0, 0.0, 2.0), ("QQQ", TARGET, 54.5, 49.330002, 40.0, 45.0, 45.0, 10.0, 0.0, 0.0),
        ("AAPL", date(2026, 8, 26), 1.0, 1.0, 1.0, 0.0, 1.0, 1.0, 0.0, 0.0), ("AAPL", date(2026, 8, 22), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0), ("AAPL", date(2026, 8, 25), None, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0),
    ]
    rows, bad, sessions, symbols = _bars(spark, bars)
    got = {r.canonical_symbol: r for r in rows.collect()}
    assert rows.columns == SCHEMAS["daily_prices"].fieldNames() and bad.count() == 1
    assert got["AAPL"].adjusted_high == got["AAPL"].adjusted_close == 0.8585 and got["BRK.B"].adjusted_low == 0.8505
    assert got["AAPL"].stock_split_ratio is None and got["BRK.B"].stock_split_ratio == 2.0
    rec = {"provider": "yahoo", "symbol": "AAPL", "date": "2026-08-27", "open": 1.0, "high": 1.01, "low": 0.99, "close": 1.01, "volume": 10.0, "price_basis": "raw_unadjusted"}
    import hashlib

    assert got["AAPL"].raw_record_sha256 == hashlib.sha256(json.dumps(rec, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    check = lambda df: {r.canonical_symbol: r.errors for r in prices.contract_errors(df, TARGET, "2026-08-27T20:00:00Z", "2026-08-27T21:00:00Z").collect()}
    errors = check(rows)
    assert errors["AAPL"] == [] and errors["BRK.B"] == [] and errors["QQQ"] == ["raw_envelope", "factor_parity_high"]
    one = rows.where("canonical_symbol = 'AAPL'")
    for change, rule in {
        "currency": "currency_is_not_USD", "volume": "negative_volume_or_factor", "available_at_utc": "available_is_not_finish", "raw_record_sha256": "raw_record_hash", "is_target_session": "is_target_session", "dividend_cash": "negative_dividend", "adjusted_open": "factor_parity_open",
        "capture_started_utc": "started_before_close", "unadjusted_low": "price_not_positive",
    }.items():
        value = {"currency": F.lit("EUR"), "volume": F.lit(-1.0), "available_at_utc": F.lit("2026-08-27T20:03:00Z"), "raw_record_sha256": F.lit("0"), "is_target_session": F.lit(False), "dividend_cash": F.lit(-1.0), "adjusted_open": F.lit(0.851), "capture_started_utc": F.lit("2026-08-27T19:59:59Z"), "unadjusted_low": F.lit(-1.0)}[change]
        assert rule in check(one.withColumn(change, value))["AAPL"], change
    assert prices.error_sample(prices.contract_errors(rows, TARGET, "2026-08-27T20:00:00Z", "2026-08-27T21:00:00Z")).count() == 2
    assert {r.canonical_symbol for r in prices.eligible(rows, sessions, TARGET).collect()} == {"AAPL", "BRK.B"}
    cov = prices.coverage(rows, symbols.select("symbol"), sessions, TARGET).first()
    assert (cov.requested_symbols, cov.symbols_with_target, cov.anchors_with_target, cov.anchors_with_full_axis, cov.duplicate_pairs, cov.ratio) == (3, 3, 1, 0, 0, 1.0)
    numbered = spark.createDataFrame([(0, "A", 1), (1, "A", 2), (2, "B", 1)], "row_no long, canonical_symbol string, bar_session int")
    assert prices.sortedness(numbered).first()[0] and not prices.sortedness(numbered.withColumn("row_no", 2 - F.col("row_no"))).first()[0]


def test_wide_bars(spark):
    pdf = pd.DataFrame({"Date": ["2026-08-26", "2026-08-27"], "AAPL|Open": [1.0, 2.0], "Adj Close|AAPL": [0.5, 0.6], "msft|close": [3.0, 4.0]})
    got = {(r.provider_symbol, r.bar_session.isoformat()): (r.open, r.adj_close, r.close) for r in prices.long_bars(spark.createDataFrame(pdf)).collect()}
    assert got["AAPL", "2026-08-27"] == (2.0, 0.6, None) and got["MSFT", "2026-08-26"] == (None, None, 3.0)


def _cftc(path, rows):
    head = ["Market_and_Exchange_Names", "Report_Date_as_YYYY-MM-DD", "CFTC_Contract_Market_Code", *feeds.CFTC_HEADERS.values()]
    text = "\n".join([",".join(head), *[",".join(f'"{x}"' for x in r) for r in rows]])
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("FinFut.txt", "﻿" + text)
    path.write_bytes(buf.getvalue())


def test_feeds(spark, tmp_path):
    day = date(2026, 8, 28)
    num = lambda oi: [*[str(10 + i) for i in range(14)], oi]
    _cftc(tmp_path / "c.zip", [["SPX, cme", d, c, *num("1,000")] for d in ("2026-08-18", "2026-08-25", "2026-09-01") for c in ("13874+", "20974+", "999")])
    got = {r.symbol: r for r in feeds.read_cftc(spark, str(tmp_path / "c.zip"), day, "t", "r", "u").collect()}
    assert set(got) == {"SP500", "NASDAQ100"} and got["SP500"].source_date == "2026-08-25" and got["SP500"].source_lag_days == 3
    assert got["SP500"].open_interest == 1000.0 and abs(got["SP500"].dealer_net_share + 0.001) < 1e-12
    (tmp_path / "f.txt").write_text("Date|Symbol|ShortVolume|ShortExemptVolume|TotalVolume|Market\n" + "\n".join(f"20260827|{s}|5|1|10|Q" for s in ("QQQ", "SPY", "AAA")) + "\n20260827|ZERO|0|0|0|Q\nbad|X|1|1|1|Q\n3\n")
    read = lambda d, **k: feeds.read_finra(spark, str(tmp_path / "f.txt"), d, "t", "r", "u", **k)
    got = {r.symbol: r for r in read(day, least_rows=3).collect()}
    assert got["QQQ"].short_volume_ratio == 0.5 and got["ZERO"].short_volume_ratio is None and got["QQQ"].source_lag_days == 1 and len(got) == 4
    for bad in (lambda: read(day), lambda: read(date(2026, 8, 26), least_rows=3)):
        with pytest.raises(feeds.FeedError):
            bad()
    head = "quantity,underlying,symbol,actype,porc,exchange,actdate\n"
    (tmp_path / "o.csv").write_text(head + "\n".join(f"{i},QQQ,QQQ,{a},{p},CBOE,08/27/2026," for i, (a, p) in enumerate([(a, p) for a in "CFM" for p in "CP"])))
    got = feeds.read_occ(spark, str(tmp_path / "o.csv"), "QQQ", day, "t", "r", "u").collect()
    assert len(got) == 6 and {r.account_type for r in got} == {"customer", "firm", "market_maker"}
    (tmp_path / "none.csv").write_text("No record(s) found\n")
    (tmp_path / "drift.csv").write_text(head.replace("porc,", "") + "1,QQQ,QQQ,C,CBOE,08/27/2026\n")
    occ = lambda name: feeds.read_occ(spark, str(tmp_path / name), "QQQ", day, "t", "r", "u")
    with pytest.raises(feeds.NotPublished):
        occ("none.csv")
    df, found = feeds.newest_available(lambda d: occ("none.csv" if d == day else "o.csv"), day)
    assert found == date(2026, 8, 27) and df.count() == 6
    with pytest.raises(feeds.FeedError) as e:
        feeds.newest_available(lambda d: occ("none.csv" if d == day else "drift.csv"), day, days=2)
    assert not isinstance(e.value, feeds.NotPublished)
    # All three as partitions pass verification, and a tampered manifest doesn't
    root = tmp_path / "archive"
    occ_all = occ("o.csv").unionByName(occ("o.csv").withColumn("symbol", F.lit("SPY")))
    frames = {"cftc_tff_positioning": feeds.read_cftc(spark, str(tmp_path / "c.zip"), day, "t", "r", "u"), "finra_short_volume": read(day, least_rows=3), "occ_account_volume": occ_all}
    manifest = {"status": "complete", "errors": {}, "datasets": {}}
    for name, frame in frames.items():
        sinks.write_partition(frame, str(root), name, day.isoformat())
        hashes = {r[0] for r in frame.select("source_sha256").distinct().collect()}
        manifest["datasets"][name] = {"status": "ok", "rows": frame.count(), "captures": [{"source_sha256": h} for h in hashes]}
    a = Archive(spark, str(root))
    assert context_errors(a, day.isoformat(), manifest) == []
    manifest["datasets"]["finra_short_volume"]["rows"] += 1
    assert context_errors(a, day.isoformat(), manifest) == ["finra_short_volume: 4 rows, manifest 5"]
    log = tmp_path / "logs"
    log.mkdir()
    (log / "a.jsonl").write_text('{"ts":"1","event":"symbol_failure","symbol":"A"}\nnot json\n{"ts":"2","event":"fine"}\n')
    assert [r.symbol for r in feeds.recent_failures(spark, str(log)).collect()] == ["A"]


def test_coverage(spark, tmp_path):
    row = lambda s, **k: {"symbol": s, "snapshot_utc": "2026-07-03T00:00:00Z", "period": "0m", **k}
    write(spark, tmp_path, "recommendations", "2026-07-02", [row("AAPL", buy=1.0), row("MSFT", no_analyst_coverage=True)])
    write(spark, tmp_path, "recommendations", "2026-07-03", [row("AAPL", no_analyst_coverage=True), row("MSFT", no_analyst_coverage=True), row("BARE")])
    exp = spark.createDataFrame([("AAPL",), ("MSFT",)], "symbol string")
    a = Archive(spark, str(tmp_path))
    got = coverage.coverage_report(a, exp, "2026-07-02", datasets=["recommendations"])["datasets"]["recommendations"]
    assert got["symbol_coverage_ratio"] == 0.5 and got["recorded_symbol_ratio"] == 1.0 and got["missing_symbols"] == ["MSFT"]
    rep = coverage.coverage_report(a, exp, datasets=["recommendations"])
    got = rep["datasets"]["recommendations"]
    assert rep["compare_date"] == "2026-07-02" and got["newly_uncovered_symbols"] == ["AAPL"] and got["symbols_with_data"] == 0
    assert not coverage.passes(rep, 0.5) and coverage.passes(rep, None)


def test_seal_and_publish(spark, tmp_path):
    root, day = tmp_path / "a", "2026-08-27"
    rows = [{"symbol": s, "snapshot_utc": "2026-08-27T20:30:00.5Z", "dataset": "recommendations", "buy": 1.0} for s in ("AAPL", "MSFT")]
    write(spark, root, "recommendations", day, rows)
    a, exp, now = Archive(spark, str(root)), spark.createDataFrame([("AAPL",), ("MSFT",)], "symbol string"), datetime(2026, 8, 27, 22, tzinfo=UTC)
    do = lambda **k: evidence.seal(a, day, **{"expected": exp, "required": ["recommendations"], "now": now} | k)
    for bad, text in (({"now": datetime(2026, 8, 27, 19, tzinfo=UTC)}, "closed"), ({"now": datetime(2026, 8, 27, 20, 10, tzinfo=UTC)}, "after the seal"), ({"required": ["profile"]}, "no rows"), ({"expected": exp.union(exp.selectExpr("concat(symbol, 'X')"))}, "coverage")):
        with pytest.raises(evidence.SealError, match=text):
            do(**bad)
        assert not (root / "_bundles").exists()
    manifest = do()
    assert evidence.manifest_errors(manifest, root) == []
    assert evidence.manifest_errors(manifest | {"status": "partial"}, root) and evidence.manifest_errors(manifest | {"extra": 1}, root)
    store = evidence.FolderStore(tmp_path / "remote")
    ready = evidence.publish(root, day, store)
    put = sorted(p.relative_to(tmp_path / "remote").as_posix() for p in (tmp_path / "remote").rglob("*") if p.is_file())
    assert put[-1] == f"ready/date={day}.json" and len(put) == 2 + len(manifest["files"]) and ready["generation"] == manifest["generation"]
    data = root / manifest["files"][0]["path"]
    data.write_bytes(data.read_bytes() + b"x")
    with pytest.raises(evidence.SealError, match="file"):
        evidence.publish(root, day, evidence.FolderStore(tmp_path / "other"))
    assert not (tmp_path / "other").exists()


def test_hashes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string")
    assert evidence.table_hash(df, ["k"]) == evidence.table_hash(df.repartition(3), ["k"]) != evidence.table_hash(df.where("k < 3"), ["k"])
    c = evidence.capture(tmp_path, "raw", b"hello")
    assert c == evidence.capture(tmp_path, "raw", b"hello") and evidence.capture_intact(tmp_path, c)
    assert evidence.block_hash(b"x" * 10, 4) != evidence.block_hash(b"x" * 10, 5)
    (tmp_path / "d.json").write_text('{"a":1,"a":2}')
    with pytest.raises(evidence.SealError):
        evidence.read_json(tmp_path / "d.json")
    assert evidence.remote_path("ds/date=2026-01-01/f") == "date=2026-01-01/ds/f"
    assert evidence.mirror(Path(tmp_path), evidence.FolderStore(tmp_path / "m")) == 0


def test_streaming_first_seen_and_panes(spark, tmp_path):
    for i, rows in enumerate(([event(), event()], [event(), event(at="2026-06-02T00:00:00")])):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ingest.read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    q = ingest.first_seen(stream).writeStream.format("memory").queryName("seen").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("seen").count() == 2
    from tidemark.operators import panes

    schema = "table_name string, symbol string, report_id long, row_id long, event_day date, arrival timestamp, value double"
    batches = [[("t", "A", 1, 1, date(2026, 3, 3), datetime(2026, 3, 4), 5.0)], [("t", "A", 1, 2, date(2026, 3, 3), datetime(2026, 3, 20), 8.0), ("t", "A", 2, 3, date(2026, 3, 4), datetime(2026, 4, 20), 100.0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/reports")
        ingest.pane_stream(ingest.read_stream(spark, f"{tmp_path}/reports", spark.createDataFrame([], schema).schema), panes.week_pane, f"{tmp_path}/store", f"{tmp_path}/c2").awaitTermination(120)
    assert [(r.symbol, r.total) for r in ingest.pane_totals(spark, f"{tmp_path}/store").collect()] == [("A", 8.0)]


def fake(item):
    yield (item["symbol"], 1.0)


def test_vendor_source(spark):
    vendor.register(spark)
    read = spark.read.format("tidemark_vendor").schema("symbol string, v double").option("backend", "tests.test_archive:fake").option("items", json.dumps([{"symbol": "A"}, {"symbol": "B"}])).option("partitions", "2").load()
    assert {r.symbol for r in read.collect()} == {"A", "B"}
    assert vendor.retryable("HTTP 429") and not vendor.retryable("404") and vendor.has_payload({"a": [0]}) and not vendor.has_payload({"a": [None, {}]})
    calls = []
    with pytest.raises(RuntimeError):
        vendor.with_retries(lambda: calls.append(1) or (_ for _ in ()).throw(RuntimeError("429")), sleep=lambda s: None)
    assert len(calls) == 3 and vendor.backoff(9) >= 60
