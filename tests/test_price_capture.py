"""A whole price capture with a fake vendor: resume, retries, tampering, seal and publish."""

from datetime import UTC, date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.calendar import session_axis, sessions_table
from tidemark.operators import evidence, price_capture
from tidemark.schemas import PRICE_ANCHORS

TARGET = date(2026, 8, 27)


class Vendor:
    def __init__(self):
        self.calls, self.now = [], datetime(2026, 8, 27, 20, 5, tzinfo=UTC)

    def clock(self):
        self.now += timedelta(seconds=1)
        return self.now

    def fetch(self, symbols, first, last):
        self.calls.append(list(symbols))
        axis = session_axis(TARGET)
        days = axis[-2:] if symbols == ["MSFT"] else axis
        out = {"Date": [d.isoformat() for d in days]}
        for s in symbols:
            if s == "NONE" or (s == "MSFT" and len(symbols) > 1):
                continue
            for k, (f, v) in enumerate({"Open": 10.0, "High": 11.0, "Low": 9.0, "Close": 10.5, "Adj Close": 5.25, "Volume": 100.0, "Dividends": 0.0, "Stock Splits": 0.0}.items()):
                out[f"{s}|{f}"] = [v] * len(days)
        return pd.DataFrame(out)


def test_capture_verify_seal(spark, tmp_path):
    root, v = str(tmp_path), Vendor()
    universe = spark.createDataFrame([("AAPL",), ("MSFT",), ("NONE",)], "symbol string")
    m = price_capture.capture(spark, root, universe, TARGET, v.fetch, "run", "1.0", v.clock)
    assert m["status"] == "complete" and m["failures"] == ["NONE"] and m["output"]["rows"] == 30 * (1 + len(PRICE_ANCHORS)) + 2
    assert len(v.calls) == 3 and ["MSFT"] in v.calls and ["NONE"] in v.calls
    now = v.now + timedelta(minutes=5)
    assert price_capture.verify(spark, root, TARGET, universe, now, 0.9) == []
    assert price_capture.verify(spark, root, TARGET, universe, now, 0.99) == ["coverage 0.941176"]
    assert "request" in price_capture.verify(spark, root, TARGET, universe.limit(2), now, 0.9)
    again = price_capture.capture(spark, root, universe, TARGET, v.fetch, "run", "1.0", v.clock)
    assert len(v.calls) == 6 and again["output"]["rows"] == m["output"]["rows"]  # a batch with a symbol that can't be published is fetched again
    now = v.now + timedelta(minutes=5)
    with pytest.raises(evidence.SealError, match="coverage"):
        price_capture.seal(spark, root, TARGET, universe, now)
    known = universe.where("symbol <> 'NONE'")
    price_capture.capture(spark, root, known, TARGET, v.fetch, "run", "1.0", v.clock)
    n = len(v.calls)
    price_capture.capture(spark, root, known, TARGET, v.fetch, "run", "1.0", v.clock)
    assert len(v.calls) == n
    names = spark.createDataFrame([(s,) for s in sorted([*PRICE_ANCHORS, "AAPL", "MSFT"])], "symbol string").withColumn("provider_symbol", F.col("symbol"))
    base = tmp_path / "_price_checkpoints" / "date=2026-08-27"
    note = evidence.read_json(base / "batch_0001.json")
    keys = ("schema", "status", "request", "batch_id", "run_id", "provider_version")
    errors = lambda **k: price_capture.checkpoint_errors(spark, str(base / "batch_0001"), base / "batch_0001.json", {x: note[x] for x in keys} | k, names, sessions_table(spark, session_axis(TARGET)[0], TARGET), TARGET)
    assert errors() == [] and errors(run_id="other") == ["another request, run, batch or provider"]
    evidence.write_json(base / "batch_0001.json", note | {"missing": ["AAPL"], "capture_finished_utc": note["capture_started_utc"]})
    assert [e.split(" ", 1)[-1] for e in errors()] == ["rows break the contract", "of symbols"]
    evidence.write_json(base / "batch_0001.json", note)
    now = v.now + timedelta(minutes=5)
    sealed = price_capture.seal(spark, root, TARGET, known, now)
    assert len(sealed["files"]) == 2
    store = evidence.FolderStore(tmp_path / "remote")
    assert evidence.publish(tmp_path, "2026-08-27", store, evidence.PRICE_BUNDLE, spark)["generation"] == sealed["generation"]
    path = tmp_path / "_price_manifests" / "date=2026-08-27" / "manifest.json"
    evidence.write_json(path, evidence.read_json(path) | {"failures": ["AAPL"]})
    wrong = price_capture.verify(spark, root, TARGET, known, now)
    assert "identity" in wrong and "failures differ from missing symbols" in wrong


def test_capture_before_the_close_is_refused(spark, tmp_path):
    with pytest.raises(evidence.SealError):
        price_capture.capture(spark, str(tmp_path), spark.createDataFrame([("AAPL",)], "symbol string"), TARGET, lambda *a: None, "r", "1", lambda: datetime(2026, 8, 27, 19, tzinfo=UTC))
