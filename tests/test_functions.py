"""Expressions on times, dates, symbols and labels in all their spellings, whatever the session's zone."""

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text

TIMES = {
    "2026-08-24T11:04:05": "2026-08-24 11:04:05", "2026-08-24T11:04:05Z": "2026-08-24 11:04:05", "2026-08-24T11:04:05.250000Z": "2026-08-24 11:04:05.25", "2026-08-24T11:04:05-04:00": "2026-08-24 15:04:05", "2026-08-24T11:04:05+02:00": "2026-08-24 09:04:05",
    "2026-08-24 11:04:05": "2026-08-24 11:04:05", " 2026-08-24 ": "2026-08-24 00:00:00", "20260824": "2026-08-24 00:00:00", "2026/08/24": "2026-08-24 00:00:00", "2026/08/24T01:02:03Z": "2026-08-24 01:02:03", "0000-00-00": None, "pending": None, "": None, None: None, "2026-13-01T00:00:00Z": None, "fooTZ": None,
}
DAYS = {"2026-03-17": date(2026, 3, 17), "20260317": date(2026, 3, 17), "2026/03/17": date(2026, 3, 17), "2026-03-17 ": date(2026, 3, 17), "2026-02-30": None, "x": None, "": None, None: None, "2026-03-17T10:00:00Z": date(2026, 3, 17), "2026-3-17": None}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_and_days(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in TIMES], "s string").select("s", F.unix_micros(text.utc_time("s")).alias("t"), text.day_of(text.utc_time("s")).alias("d"))
        for r in df.collect():
            want = TIMES[r.s] and datetime.fromisoformat(TIMES[r.s]).replace(tzinfo=UTC)
            assert r.t == (want and round(want.timestamp() * 1e6)), r
            assert r.d == (want and want.date())
        got = {r.s: r.d for r in spark.createDataFrame([(k,) for k in DAYS], "s string").select("s", text.utc_day("s").alias("d")).collect()}
        assert got == DAYS
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_symbols_and_labels(spark):
    symbols = {"OMNIA": "OMNIA", " fhrjg.b ": "FHRJG-B", "LCHWJ/A": "LCHWJ-A", "LCHWJ-A": "LCHWJ-A", "rdjtf\t": "RDJTF", "a b": "A-B", "": "", None: None}
    got = {r.s: r.n for r in spark.createDataFrame([(k,) for k in symbols], "s string").select("s", text.norm_symbol("s").alias("n")).collect()}
    assert got == symbols
    labels = {"Real_Estate": "realestate", " real  estate": "realestate", "Power—Regulated": "powerregulated", "N/A": None, "-": None, "": None, None: None, "Unknown": None}
    got = {r.s: r.n for r in spark.createDataFrame([(k,) for k in labels], "s string").select("s", text.label_key("s").alias("n")).collect()}
    assert got == labels
