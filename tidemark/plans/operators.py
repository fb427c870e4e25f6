"""Queries that run the archive's operators themselves: over an archive, a universe, payloads and bars made of the test tables, each with its SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import sessions_table
from ..functions.text import utc_day
from ..operators import asof, coverage, normalize, prices, universe
from ..session import scratch_path, table
from ..sources import feeds, sinks
from ..sources.archive import Archive
from .changes import AT_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: (application, folder of tables) -> archive made of them
_ARCHIVES: dict[tuple[str, str], str] = {}
DAY, BEFORE = "2026-07-10", "2026-07-03"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def archive_of(spark: SparkSession, d: str) -> Archive:
    """The snapshot tables as an archive in the shared folder, one partition for each trading_date; made once in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _ARCHIVES:
        root = scratch_path(spark, "archive")
        for name in ("recommendations", "estimates", "profile"):
            rows = table(spark, d, name).withColumnRenamed("trading_date", "date")
            rows.repartition("date").write.partitionBy("date").parquet(f"{root}/{name}")
        _ARCHIVES[key] = root
    return Archive(spark, _ARCHIVES[key])


# --- scans ---------------------------------------------------------------------------------------------------------------


@query("SELECT row_id, symbol, trading_date, avg FROM estimates WHERE trading_date BETWEEN '2026-06-12' AND '2026-07-03' AND symbol IN ('OMNIA', 'QLCMF', 'QWTMV') AND NOT coalesce(no_analyst_coverage, false)")
def scan_range_and_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Archive.load: partitions in a range, symbols of a list, no markers, chosen columns."""
    return archive_of(spark, d).load("estimates", "2026-06-12", "2026-07-03", ["OMNIA", "QLCMF", "QWTMV"], ["avg", "row_id"]).select("row_id", "symbol", "trading_date", "avg")


@query(f"SELECT row_id, strftime({AT_SQL} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS known_at FROM profile WHERE {AT_SQL} <= TIMESTAMPTZ '2026-07-01 00:00:00+00'")
def as_of_filter(spark: SparkSession, d: str) -> DataFrame:
    """Archive.load as of a time, whatever form the rows' times are written in; markers are kept."""
    p = archive_of(spark, d).load("profile", columns=["row_id"], as_of="2026-07-01T00:00:00Z", drop_no_coverage=False)
    return p.select("row_id", F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("known_at"))


@query("SELECT DISTINCT trading_date FROM (SELECT trading_date FROM recommendations UNION ALL SELECT trading_date FROM estimates UNION ALL SELECT trading_date FROM profile)")
def available_dates(spark: SparkSession, d: str) -> DataFrame:
    """Archive.all_dates: partitions of any dataset, from the listing of folders."""
    return spark.createDataFrame([(x,) for x in archive_of(spark, d).all_dates()], "trading_date string")


@query("SELECT trading_date, max(prev) AS prev FROM (SELECT DISTINCT p.trading_date, q.trading_date AS prev FROM profile p JOIN (SELECT DISTINCT trading_date FROM profile) q ON q.trading_date < p.trading_date) GROUP BY 1")
def previous_partition(spark: SparkSession, d: str) -> DataFrame:
    """Archive.previous_date of every partition."""
    a = archive_of(spark, d)
    return spark.createDataFrame([(x, p) for x in a.dates("profile") if (p := a.previous_date(x))], "trading_date string, prev string")


@query("SELECT dataset, partitions, first_date, last_date FROM (SELECT 'profile' AS dataset, count(DISTINCT trading_date) AS partitions, min(trading_date) AS first_date, max(trading_date) AS last_date FROM profile UNION ALL SELECT 'estimates', count(DISTINCT trading_date), min(trading_date), max(trading_date) FROM estimates UNION ALL SELECT 'earnings', 0, NULL, NULL)")
def archive_summary(spark: SparkSession, d: str) -> DataFrame:
    """Archive.summary of two datasets and of one that has no partition."""
    s = archive_of(spark, d).summary().where("dataset in ('profile', 'estimates', 'earnings')")
    return s.select("dataset", F.col("partitions").cast("long").alias("partitions"), "first_date", "last_date")


@query("SELECT trading_date, count(DISTINCT symbol) AS n_symbols, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols FROM profile WHERE symbol IS NOT NULL GROUP BY 1")
def per_date_universe(spark: SparkSession, d: str) -> DataFrame:
    """Archive.universe_by_date: who was in each partition."""
    u = archive_of(spark, d).universe_by_date("profile")
    return u.select("trading_date", "n_symbols", F.array_join("symbols", ",").alias("symbols"))


@query(f"""SELECT symbol, period, max(trading_date) AS trading_date, strftime(known AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS known_at FROM (SELECT *, {AT_SQL} AS known, max({AT_SQL}) OVER (PARTITION BY symbol, period) AS last FROM recommendations
    WHERE NOT coalesce(no_analyst_coverage, false) AND {AT_SQL} <= TIMESTAMPTZ '2026-07-20 12:00:00+00' AND trading_date BETWEEN '2026-07-10' AND '2026-07-20') WHERE known = last GROUP BY 1, 2, 4""")
def latest_in_archive(spark: SparkSession, d: str) -> DataFrame:
    """Archive.latest_as_of per symbol and period, from ten days of partitions."""
    r = archive_of(spark, d).latest_as_of("recommendations", "2026-07-20T12:00:00Z", group_extra=["period"])
    return r.select("symbol", "period", "trading_date", F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("known_at"))


# --- coverage and resume -------------------------------------------------------------------------------------------------

_HELD = " INTERSECT ".join(f"SELECT symbol FROM {t} WHERE trading_date = '{DAY}'" for t in ("recommendations", "estimates", "profile"))


@query(f"SELECT symbol FROM ({_HELD}) WHERE symbol IS NOT NULL AND trim(symbol) <> ''")
def complete_in_all(spark: SparkSession, d: str) -> DataFrame:
    """sinks.complete_symbols: what a resumed run skips."""
    return sinks.complete_symbols(archive_of(spark, d), ["recommendations", "estimates", "profile"], DAY)


@query(f"SELECT s.symbol, t.dataset FROM (SELECT DISTINCT symbol FROM profile WHERE symbol IS NOT NULL) s CROSS JOIN (SELECT unnest(['recommendations', 'estimates']) AS dataset) t WHERE NOT EXISTS (SELECT 1 FROM (SELECT symbol, 'recommendations' AS dataset FROM recommendations WHERE trading_date = '{DAY}' UNION ALL SELECT symbol, 'estimates' FROM estimates WHERE trading_date = '{DAY}') h WHERE h.symbol = s.symbol AND h.dataset = t.dataset)")
def missing_pairs(spark: SparkSession, d: str) -> DataFrame:
    """sinks.missing_pairs: symbol and dataset still to be fetched."""
    symbols = table(spark, d, "profile").where("symbol is not null").select("symbol").distinct()
    return sinks.missing_pairs(archive_of(spark, d), symbols, ["recommendations", "estimates"], DAY)


_VALUES = " OR ".join(f'"{c}" IS NOT NULL' for c in ("strongBuy", "buy", "hold", "sell", "strongSell"))
_MARKED = "SELECT DISTINCT symbol FROM recommendations WHERE trading_date = '{}' AND coalesce(no_analyst_coverage, false)"


@query(f"""WITH e AS (SELECT DISTINCT symbol FROM profile WHERE symbol IS NOT NULL), t AS (SELECT * FROM recommendations WHERE trading_date = '{DAY}'), w AS (SELECT DISTINCT symbol FROM t WHERE NOT coalesce(no_analyst_coverage, false) AND symbol IS NOT NULL)
    SELECT (SELECT count(*) FROM e JOIN w USING (symbol)) AS symbols_with_data, round((SELECT count(*) FROM e JOIN w USING (symbol)) * 1.0 / (SELECT count(*) FROM e), 4) AS symbol_coverage_ratio, (SELECT count(*) FROM t) AS run_date_rows, (SELECT count(DISTINCT symbol) FROM t) AS run_date_symbols,
        (SELECT count(*) FROM recommendations WHERE trading_date = '{BEFORE}') AS compare_date_rows, (SELECT count(*) FROM ({_MARKED.format(DAY)} EXCEPT {_MARKED.format(BEFORE)} INTERSECT SELECT symbol FROM recommendations WHERE trading_date = '{BEFORE}')) AS newly_uncovered,
        (SELECT string_agg(symbol, ',' ORDER BY symbol) FROM (SELECT symbol FROM e WHERE symbol NOT IN (SELECT symbol FROM w) ORDER BY symbol LIMIT 50)) AS missing""")
def coverage_of_a_day(spark: SparkSession, d: str) -> DataFrame:
    """coverage.dataset_coverage of one day against the day before (the sample of missing symbols is the feature's)."""
    expected = table(spark, d, "profile").where("symbol is not null").select("symbol").distinct()
    r = coverage.dataset_coverage(archive_of(spark, d), "recommendations", expected, DAY, BEFORE)
    row = (r["symbols_with_data"], r["symbol_coverage_ratio"], r["run_date_rows"], r["run_date_symbols_snapshotted"], r["compare_date_rows"], r["newly_uncovered_symbols_count"], ",".join(r["missing_symbols"]) or None)
    return spark.createDataFrame([row], "symbols_with_data long, symbol_coverage_ratio double, run_date_rows long, run_date_symbols long, compare_date_rows long, newly_uncovered long, missing string")


# --- events ----------------------------------------------------------------------------------------------------------------


def _blank_sql(c: str) -> str:
    return rf"CASE WHEN {c} IS NULL OR regexp_matches({c}, '^\s*$') THEN '' ELSE {c} END"


_KEY_COLUMNS = ["symbol", '"GradeDate"', '"Firm"', '"FromGrade"', '"ToGrade"', '"Action"']
_KEYED = "(SELECT row_id, run_id, " + ", ".join(f"{_blank_sql(c)} AS k{i}" for i, c in enumerate(_KEY_COLUMNS)) + " FROM upgrades_downgrades)"
_SAME = " AND ".join(f"o.k{i} = n.k{i}" for i in range(len(_KEY_COLUMNS)))


def _events(spark: SparkSession, d: str) -> DataFrame:
    """Rating actions with canonical columns, first seen in the order of row_id."""
    u = sinks.canonical_events(table(spark, d, "upgrades_downgrades"))
    return u.withColumn("first_seen_utc", F.lpad(F.col("row_id").cast("string"), 20, "0"))


@query(f"SELECT count(*) AS n_events, min(row_id) AS first_row, max(row_id) AS last_row FROM (SELECT min(row_id) AS row_id FROM {_KEYED} GROUP BY k0, k1, k2, k3, k4, k5)")
def event_index(spark: SparkSession, d: str) -> DataFrame:
    """asof.first_per_key over asof.event_key: blanks in keys are equal, values aren't trimmed."""
    e = _events(spark, d)
    first = asof.first_per_key(e.select("*", *asof.event_key()), [f"__{c}" for c in asof.EVENT_KEY], ["first_seen_utc"])
    return first.agg(F.count("*").alias("n_events"), F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"))


@query(f"SELECT min(row_id) AS row_id FROM {_KEYED} n WHERE run_id >= 'run_20260814' AND NOT EXISTS (SELECT 1 FROM {_KEYED} o WHERE o.run_id < 'run_20260814' AND {_SAME}) GROUP BY k0, k1, k2, k3, k4, k5")
def new_events(spark: SparkSession, d: str) -> DataFrame:
    """asof.new_events: what the index doesn't hold, each once, the earliest seen."""
    e = _events(spark, d)
    return asof.new_events(e.where("run_id >= 'run_20260814'"), e.where("run_id < 'run_20260814'")).select("row_id")


_HEAD = "split_part(split_part(g, 'T', 1), ' ', 1)"


@query(rf"""SELECT row_id, firm, "fromGrade", "toGrade", action, event_utc, strftime(CASE WHEN regexp_matches({_HEAD}, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN try_strptime({_HEAD}, '%Y-%m-%d') WHEN regexp_matches({_HEAD}, '^\d{{8}}$') THEN try_strptime({_HEAD}, '%Y%m%d') END, '%Y-%m-%d') AS event_date
    FROM (SELECT row_id, nullif({_blank_sql('"Firm"')}, '') AS firm, nullif({_blank_sql('"FromGrade"')}, '') AS "fromGrade", nullif({_blank_sql('"ToGrade"')}, '') AS "toGrade", nullif({_blank_sql('"Action"')}, '') AS action, nullif({_blank_sql('"GradeDate"')}, '') AS event_utc, nullif({_blank_sql('"GradeDate"')}, '') AS g FROM upgrades_downgrades)""")
def event_canonicalise(spark: SparkSession, d: str) -> DataFrame:
    """sinks.canonical_events: each column from whichever spelling holds a value, and the event's date."""
    return sinks.canonical_events(table(spark, d, "upgrades_downgrades")).select("row_id", "firm", "fromGrade", "toGrade", "action", "event_utc", "event_date")


# --- payloads and universe -------------------------------------------------------------------------------------------------


@query("""SELECT symbol, "current", mean, low, no_analyst_coverage FROM (SELECT 'E' || event_id AS symbol, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS "current", CASE WHEN event_id % 10 = 0 OR event_id % 7 = 0 THEN NULL ELSE value END AS mean, CAST(NULL AS DOUBLE) AS low,
    CASE WHEN event_id % 10 = 0 THEN true END AS no_analyst_coverage FROM events)""")
def payload_props_k(spark: SparkSession, d: str) -> DataFrame:
    """normalize.parse_payloads: vendor JSON to typed core rows; words for NaN are null, an empty payload is a marker."""
    e = table(spark, d, "events")
    mean = F.when(F.col("event_id") % 7 == 0, F.lit("NaN")).otherwise(F.col("value").cast("string"))
    payload = F.when(F.col("event_id") % 10 != 0, F.to_json(F.struct(F.get_json_object("props", "$.k").cast("int").alias("current"), mean.alias("mean"), F.lit("x").alias("note"))))
    p = e.select(F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("symbol"), F.lit("2024-02-01T00:00:00Z").alias("snapshot_utc"), payload.alias("payload"))
    return normalize.parse_payloads(p, "analyst_price_targets", "run").select("symbol", "current", "mean", "low", "no_analyst_coverage")


_LISTING = "SELECT upper(replace('p/' || p_partkey, '/', '-')) AS symbol, p_name || CASE p_partkey % 6 WHEN 1 THEN ' Units' WHEN 2 THEN ' Preferred Stock' WHEN 3 THEN ' 5% Notes due' WHEN 4 THEN ' Warrant' ELSE ' Common Stock' END AS name, p_retailprice AS cap, p_partkey % 11 = 0 AS odd FROM part"


def _listings(spark: SparkSession, d: str) -> DataFrame:
    p, m = table(spark, d, "part"), F.col("p_partkey") % 6
    kind = F.when(m == 1, " Units").when(m == 2, " Preferred Stock").when(m == 3, " 5% Notes due").when(m == 4, " Warrant").otherwise(" Common Stock")
    symbol = F.concat(F.lit("p/"), F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 11 == 0, "^").otherwise(""))
    return p.select(symbol.alias("symbol"), F.concat("p_name", kind).alias("name"), F.concat(F.lit("$"), F.col("p_retailprice").cast("string")).alias("marketCap"))


@query(f"SELECT symbol FROM ({_LISTING}) WHERE regexp_matches(name, 'Common Stock$') AND NOT odd AND cap >= 950 UNION SELECT 'OLD'")
def universe_filter_parts(spark: SparkSession, d: str) -> DataFrame:
    """universe.select_symbols: equities with plain symbols above a market value, and the symbols carried over."""
    return universe.select_symbols(_listings(spark, d), spark.createDataFrame([("OLD",)], "symbol string"), 950.0)[0]


@query(f"SELECT count(*) AS listings, count(CASE WHEN n THEN 1 END) AS after_security_filter, count(CASE WHEN n AND cap >= 950 THEN 1 END) AS after_market_cap_filter, 1 AS carried_over, count(CASE WHEN n AND cap >= 950 THEN 1 END) + 1 AS total FROM (SELECT *, regexp_matches(name, 'Common Stock$') AND NOT odd AS n FROM ({_LISTING}))")
def universe_funnel(spark: SparkSession, d: str) -> DataFrame:
    """How many listings pass each step of universe.select_symbols."""
    return universe.select_symbols(_listings(spark, d), spark.createDataFrame([("OLD",)], "symbol string"), 950.0)[1]


# --- bars ------------------------------------------------------------------------------------------------------------------

FIRST, TARGET = date(2024, 1, 2), date(2024, 1, 19)
# The exchange's sessions in that time
_SESSIONS = "(SELECT CAST(unnest(['2024-01-02', '2024-01-03', '2024-01-04', '2024-01-05', '2024-01-08', '2024-01-09', '2024-01-10', '2024-01-11', '2024-01-12', '2024-01-16', '2024-01-17', '2024-01-18', '2024-01-19']) AS DATE) AS bar_session)"
_BARS = "(SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS bar_session, arg_min(value, (ts, event_id)) AS o, max(value) AS h, min(value) AS l, arg_max(value, (ts, event_id)) AS c, CAST(count(*) AS DOUBLE) AS v, arg_max(value, (ts, event_id)) * (0.5 + user_id % 4 / 8.0) AS a FROM events GROUP BY user_id, CAST(ts AS DATE))"
_ADJUSTED = f"(SELECT *, a / c AS f, o * (a / c) AS ao, a AS ac, greatest(h * (a / c), o * (a / c), a) AS ah, least(l * (a / c), o * (a / c), a) AS al FROM {_BARS})"


def vendor_bars(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars of every user's events, in the vendor's form."""
    at, user = F.struct("ts", "event_id"), F.col("user_id")
    close = F.max_by("value", at)
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("bar_session")).agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), close.alias("close"), F.count("*").cast("double").alias("volume"),
    ).select(F.concat(F.lit("U"), user.cast("string")).alias("provider_symbol"), "bar_session", "open", "high", "low", "close", (F.col("close") * (0.5 + F.pmod(user, F.lit(4)) / 8.0)).alias("adj_close"), "volume", F.lit(0.0).alias("dividend_cash"), F.lit(0.0).alias("stock_split_ratio"))


def _contract_rows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    bars, sessions = vendor_bars(spark, d), sessions_table(spark, FIRST, TARGET)
    names = table(spark, d, "events").select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")).distinct().withColumn("provider_symbol", F.col("symbol"))
    at = "2024-01-19T22:00:00Z"
    stamps = {"run_id": "r", "provider_version": "1", "batch_id": "b", "capture_started_utc": at, "capture_finished_utc": at, "available_at_utc": at}
    return prices.build_rows(bars, names, sessions, TARGET, stamps)[0], sessions


@query(f"SELECT symbol, strftime(bar_session, '%Y-%m-%d') AS bar_session, f AS adjustment_factor, ao AS adjusted_open, ah AS adjusted_high, al AS adjusted_low, ac AS adjusted_close, CAST(NULL AS DOUBLE) AS stock_split_ratio FROM {_ADJUSTED}")
def adjusted_bars(spark: SparkSession, d: str) -> DataFrame:
    """prices.adjust: prices times the factor, with the envelope widened to hold the adjusted open and close."""
    return prices.adjust(vendor_bars(spark, d)).select(F.col("provider_symbol").alias("symbol"), F.date_format("bar_session", "yyyy-MM-dd").alias("bar_session"), "adjustment_factor", "adjusted_open", "adjusted_high", "adjusted_low", "adjusted_close", "stock_split_ratio")


@query(f"""SELECT symbol, strftime(bar_session, '%Y-%m-%d') AS bar_session, concat_ws(',', CASE WHEN symbol LIKE '%3' THEN 'currency_is_not_USD' END, CASE WHEN v >= 2 THEN 'negative_volume_or_factor' END, CASE WHEN even AND ao * 1.1 > ah THEN 'adjusted_envelope' END, CASE WHEN even THEN 'factor_parity_open' END, CASE WHEN v >= 2 THEN 'raw_record_hash' END) AS errors
    FROM (SELECT *, day(bar_session) % 2 = 0 AS even FROM {_ADJUSTED} WHERE bar_session IN (SELECT bar_session FROM {_SESSIONS}))""")
def row_contract_errors(spark: SparkSession, d: str) -> DataFrame:
    """prices.contract_errors over rows of prices.build_rows, some of them spoilt."""
    rows = _contract_rows(spark, d)[0]
    even = F.dayofmonth("bar_session") % 2 == 0
    bad = rows.withColumns({"currency": F.when(F.col("symbol").endswith("3"), "EUR").otherwise(F.col("currency")), "volume": F.when(F.col("volume") >= 2, -F.col("volume")).otherwise(F.col("volume")), "adjusted_open": F.when(even, F.col("adjusted_open") * 1.1).otherwise(F.col("adjusted_open"))})
    checked = prices.contract_errors(bad, TARGET, "2024-01-19T21:00:00Z", "2024-01-19T23:00:00Z")
    return checked.select("symbol", F.date_format("bar_session", "yyyy-MM-dd").alias("bar_session"), F.array_join("errors", ",").alias("errors"))


@query(f"SELECT symbol FROM {_BARS} b JOIN {_SESSIONS} s USING (bar_session) GROUP BY symbol HAVING CASE WHEN symbol IN ('U1', 'U2', 'U3') THEN count(DISTINCT bar_session) = 13 ELSE bool_or(bar_session = DATE '2024-01-19') END")
def tail_completeness(spark: SparkSession, d: str) -> DataFrame:
    """prices.eligible: anchors need every session of the axis, others the target."""
    rows, sessions = _contract_rows(spark, d)
    return prices.eligible(rows, sessions, TARGET, ["U1", "U2", "U3"]).select(F.col("canonical_symbol").alias("symbol"))


@query(f"""WITH b AS (SELECT b.* FROM {_BARS} b JOIN {_SESSIONS} s USING (bar_session)), p AS (SELECT symbol, count(DISTINCT bar_session) AS n, bool_or(bar_session = DATE '2024-01-19') AS t FROM b GROUP BY 1)
    SELECT (SELECT count(DISTINCT user_id) FROM events) + 1 AS requested_symbols, count(CASE WHEN t THEN 1 END) AS symbols_with_target, count(CASE WHEN n = 13 THEN 1 END) AS symbols_with_full_axis, (SELECT count(DISTINCT user_id) FROM events) + 1 - count(CASE WHEN t THEN 1 END) AS missing_symbols,
        0 AS unknown_symbols, count(CASE WHEN t THEN 1 END) AS target_rows, (SELECT count(*) FROM b WHERE bar_session <> DATE '2024-01-19') AS history_rows, 0 AS duplicate_pairs FROM p""")
def price_coverage(spark: SparkSession, d: str) -> DataFrame:
    """prices.coverage: one row of counts."""
    rows, sessions = _contract_rows(spark, d)
    asked = table(spark, d, "events").select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")).distinct().union(spark.createDataFrame([("NONE",)], "symbol string"))
    return prices.coverage(rows, asked, sessions, TARGET).select("requested_symbols", "symbols_with_target", "symbols_with_full_axis", "missing_symbols", "unknown_symbols", "target_rows", "history_rows", "duplicate_pairs")


@query("SELECT row_id, date_diff('day', CAST(strptime(substr(regexp_replace(source_date, '[^0-9]', '', 'g'), 1, 8), '%Y%m%d') AS DATE), DATE '2026-08-21') AS lag_days FROM finra_short_volume")
def source_lag(spark: SparkSession, d: str) -> DataFrame:
    """feeds.source_lag: days from a report's date to the run's."""
    return table(spark, d, "finra_short_volume").select("row_id", feeds.source_lag(date(2026, 8, 21), utc_day("source_date")).alias("lag_days"))
