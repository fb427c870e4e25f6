"""Problems 1, 2, 3, 5 and 6 over the archive's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import data_rows, is_blank, norm_symbol, present, strip, utc_day, utc_time
from ..operators import asof_join, history, panes, quality, snapshot_diff
from ..schemas import CFTC_NET_SHARES, CFTC_NUMBERS, CFTC_TEXT, FINRA_NUMBERS, PROFILE_FIELDS, PROFILE_TEXT
from ..session import table

TARGET_VALUES = ["current", "low", "high", "mean", "median"]
RECOMMENDATION_VALUES = ["strongBuy", "buy", "hold", "sell", "strongSell"]
ESTIMATE_VALUES = ["avg", "low", "high", "growth", "numberOfAnalysts", "yearAgoEps", "yearAgoRevenue", "current", "7daysAgo", "30daysAgo", "60daysAgo", "90daysAgo", "upLast7days", "upLast30days", "downLast7Days", "downLast30days"]
SNAPSHOTS = {"analyst_price_targets": ([], TARGET_VALUES), "recommendations": (["period"], RECOMMENDATION_VALUES), "estimates": (["estimate_table", "period"], ESTIMATE_VALUES)}


def snapshot_rows(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Data rows with the normalised symbol and the arrival as a time `at`."""
    return table(spark, d, name).where(data_rows()).withColumn("symbol", norm_symbol("symbol")).withColumn("at", utc_time("snapshot_utc"))


# --- 1 ---------------------------------------------------------------------------------------------------------------


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for name, (extra, values) in SNAPSHOTS.items():
        key = F.concat_ws("|", F.coalesce("symbol", F.lit("")), *[F.coalesce(F.col(c), F.lit("")) for c in extra])
        parts.append(snapshot_diff.latest_records(snapshot_rows(spark, d, name), name, key, values))
    out = snapshot_diff.snapshot_changes(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return out.select("table_name", "record_key", F.col("load").alias("trading_date"), "change_kind")


def p1_change_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many records of each kind every load brought."""
    return p1_found(spark, d).groupBy("table_name", "trading_date", "change_kind").agg(F.count("*").alias("n_records"))


SYMBOL_SQL = r"regexp_replace(upper(regexp_replace(symbol, '^\s+|\s+$', '', 'g')), '[\s./_-]+', '-', 'g')"
AT_SQL = "CAST(snapshot_utc AS TIMESTAMPTZ)"


def _present_sql(c: str) -> str:
    return f'CASE WHEN isnan("{c}") THEN NULL ELSE "{c}" END'


def _p1_sql() -> str:
    parts = []
    for name, (extra, values) in SNAPSHOTS.items():
        key = " || '|' || ".join([SYMBOL_SQL, *[f"coalesce({c}, '')" for c in extra]])
        vals = ", ".join(f'{_present_sql(v)} AS "{v}"' for v in values)
        diff = " OR ".join(f"""(n."{v}" IS NULL) <> (o."{v}" IS NULL) OR (n."{v}" <> o."{v}" AND (isinf(n."{v}") OR isinf(o."{v}") OR abs(n."{v}" - o."{v}") > 1e-6 * greatest(abs(n."{v}"), abs(o."{v}"))))""" for v in values)
        parts.append(f"""SELECT '{name}' AS table_name, coalesce(n.record_key, o.record_key) AS record_key, d.trading_date AS trading_date,
            CASE WHEN o.record_key IS NULL THEN 'added' WHEN n.record_key IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
        FROM (SELECT trading_date, lag(trading_date) OVER (ORDER BY trading_date) AS prev FROM (SELECT DISTINCT trading_date FROM {name})) d
        JOIN (SELECT DISTINCT record_key FROM {name}_r) k ON d.prev IS NOT NULL
        LEFT JOIN {name}_r n ON n.record_key = k.record_key AND n.trading_date = d.trading_date
        LEFT JOIN {name}_r o ON o.record_key = k.record_key AND o.trading_date = d.prev
        WHERE (n.record_key IS NOT NULL OR o.record_key IS NOT NULL) AND (n.record_key IS NULL OR o.record_key IS NULL OR {diff})""")
        parts[-1] = (name, f"""{name}_r AS (SELECT * FROM (SELECT {key} AS record_key, trading_date, {vals}, row_number() OVER (PARTITION BY {key}, trading_date ORDER BY {AT_SQL} DESC, row_id) AS rn
            FROM {name} WHERE NOT coalesce(no_analyst_coverage, false)) WHERE rn = 1)""", parts[-1])
    return "WITH " + ", ".join(x[1] for x in parts) + " " + " UNION ALL ".join(x[2] for x in parts)


# --- 2 ---------------------------------------------------------------------------------------------------------------


def _reports(spark: SparkSession, d: str, name: str, value: str) -> DataFrame:
    return table(spark, d, name).select(
        F.lit(name).alias("table_name"), norm_symbol("symbol").alias("symbol"), "report_id", "row_id", utc_day("source_date").alias("event_day"), utc_time("snapshot_utc").alias("arrival"), F.col(value).cast("double").alias("value")
    )


def market_changes(spark: SparkSession, d: str) -> DataFrame:
    """FINRA's volumes as changes to weekly panes, CFTC's open interest as changes to monthly ones."""
    weekly = panes.revisions(_reports(spark, d, "finra_short_volume", "total_volume"), panes.week_pane)
    return panes.pane_changes(weekly.unionByName(panes.revisions(_reports(spark, d, "cftc_tff_positioning", "open_interest"), panes.month_pane)))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return panes.late_cases(market_changes(spark, d))


def _emitted(e: DataFrame, start: str) -> DataFrame:
    return e.select("table_name", "symbol", F.date_format("window_start", "yyyy-MM-dd").alias(start), F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "version", F.round("total", 2).alias("total"), "correction")


def p2_totals(spark: SparkSession, d: str) -> DataFrame:
    """Every published and corrected total: version 0 is what stood at publication."""
    return _emitted(panes.emissions(market_changes(spark, d)), "period_start")


def p2_sliding_totals(spark: SparkSession, d: str) -> DataFrame:
    """Four-week totals that slide by a week: published when their last week is, emitted again whenever a week they cover changed later."""
    weekly = panes.pane_changes(panes.revisions(_reports(spark, d, "finra_short_volume", "total_volume"), panes.week_pane))
    return _emitted(panes.emissions(weekly, 4, 7), "window_start")


def p2_left_out(spark: SparkSession, d: str) -> DataFrame:
    """How many rows came after the cut-off or can't be read."""
    both = _reports(spark, d, "finra_short_volume", "total_volume").unionByName(_reports(spark, d, "cftc_tff_positioning", "open_interest"))
    return panes.left_out(both)


def _p2_changes_sql() -> str:
    def one(name: str, value: str, unit: str) -> str:
        return f"""SELECT '{name}' AS table_name, {SYMBOL_SQL} AS symbol, report_id, row_id, CASE WHEN isnan({value}) THEN NULL ELSE {value} END AS value, {AT_SQL} AS arrival,
            CAST(strptime(substr(regexp_replace(source_date, '[^0-9]', '', 'g'), 1, 8), '%Y%m%d') AS DATE) AS day, '{unit}' AS unit FROM {name}"""

    return f"""rows AS ({one('finra_short_volume', 'total_volume', 'week')} UNION ALL {one('cftc_tff_positioning', 'open_interest', 'month')}),
        c AS (SELECT *, CAST(CASE WHEN unit = 'week' THEN date_trunc('week', day) ELSE date_trunc('month', day) END AS DATE) AS pane,
                CAST(CASE WHEN unit = 'week' THEN date_trunc('week', day) + INTERVAL 7 DAY ELSE date_trunc('month', day) + INTERVAL 1 MONTH END AS DATE) AS pane_end,
                CAST(arrival AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc FROM rows WHERE day IS NOT NULL AND arrival IS NOT NULL),
        k AS (SELECT *, lag(value) OVER (PARTITION BY table_name, report_id ORDER BY utc, row_id) AS previous, row_number() OVER (PARTITION BY table_name, report_id ORDER BY utc, row_id) AS nr,
                utc >= CAST(pane_end AS TIMESTAMP) + INTERVAL 4 DAY AS late
              FROM c WHERE date_diff('day', day, CAST(utc AS DATE)) <= 21)"""


def _p2_sql() -> str:
    return f"WITH {_p2_changes_sql()} SELECT DISTINCT table_name, symbol, strftime(pane, '%Y-%m-%d') AS period_start, report_id FROM k WHERE late AND (nr = 1 OR value IS DISTINCT FROM previous)"


def _p2_totals_sql() -> str:
    return f"""WITH {_p2_changes_sql()}, s AS (SELECT table_name, symbol, pane, CASE WHEN late THEN CAST(utc AS DATE) ELSE DATE '1970-01-01' END AS as_of, sum(coalesce(value, 0) - CASE WHEN nr = 1 THEN 0 ELSE coalesce(previous, 0) END) AS delta FROM k
            WHERE nr = 1 OR late OR value IS NOT NULL OR previous IS NOT NULL GROUP BY 1, 2, 3, 4)
        SELECT table_name, symbol, strftime(pane, '%Y-%m-%d') AS period_start, strftime(as_of, '%Y-%m-%d') AS as_of, CAST(row_number() OVER (PARTITION BY table_name, symbol, pane ORDER BY as_of) - 1 AS INTEGER) AS version,
            round(sum(delta) OVER (PARTITION BY table_name, symbol, pane ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS total, as_of > DATE '1970-01-01' AS correction FROM s"""


def _p2_sliding_sql() -> str:
    return f"""WITH {_p2_changes_sql()}, v AS (SELECT table_name, symbol, CAST(pane - to_days(CAST(7 * j AS INTEGER)) AS DATE) AS window_start, CAST(utc AS DATE) AS day, coalesce(value, 0) - CASE WHEN nr = 1 THEN 0 ELSE coalesce(previous, 0) END AS delta
            FROM k CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS j) WHERE unit = 'week'),
        s AS (SELECT table_name, symbol, window_start, CASE WHEN day >= window_start + INTERVAL 32 DAY THEN day ELSE DATE '1970-01-01' END AS as_of, sum(delta) AS delta FROM v GROUP BY 1, 2, 3, 4)
        SELECT table_name, symbol, strftime(window_start, '%Y-%m-%d') AS window_start, strftime(as_of, '%Y-%m-%d') AS as_of, CAST(row_number() OVER w - 1 AS INTEGER) AS version, round(sum(delta) OVER w, 2) AS total, as_of > DATE '1970-01-01' AS correction
        FROM s WINDOW w AS (PARTITION BY table_name, symbol, window_start ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _p2_left_out_sql() -> str:
    return f"""WITH {_p2_changes_sql()} SELECT table_name, CASE WHEN day IS NULL OR utc IS NULL OR report_id IS NULL THEN 'unreadable' ELSE 'too late' END AS reason, count(*) AS n_rows
        FROM (SELECT *, CAST(arrival AT TIME ZONE 'UTC' AS TIMESTAMP) AS utc FROM rows) WHERE day IS NULL OR utc IS NULL OR report_id IS NULL OR date_diff('day', day, CAST(utc AS DATE)) > 21 GROUP BY 1, 2"""


# --- 3 ---------------------------------------------------------------------------------------------------------------

META = ("row_id", "trading_date", "symbol", "snapshot_utc", "dataset", "run_id", "no_analyst_coverage")
WATCHED = [("profile", "shortPercentOfFloat"), ("analyst_price_targets", "median"), ("recommendations", "hold")]


def _rules(name: str) -> dict:
    if name == "profile":
        v = present(F.col("shortPercentOfFloat"))
        return {"shortPercentOfFloat": v.isNotNull() & ((v < 0) | (v > 1))}
    if name == "recommendations":
        v = present(F.col("hold"))
        return {"hold": v.isNotNull() & ((v < 0) | (v > 500))}
    if name == "analyst_price_targets":
        v, low, high = (present(F.col(c)) for c in ("median", "low", "high"))
        bad = (F.abs(v) == float("inf")) | (v <= 0) | F.coalesce(v < low, F.lit(False)) | F.coalesce(v > high, F.lit(False))
        return {"median": v.isNotNull() & bad}
    return {}


#: What a text of these columns looks like without blanks at its ends; any other text has a letter or digit and no control or replacement character.
PATTERNS = {"source_sha256": "^[0-9a-f]{64}$", "source_url": r"^https?://\S+$", "currency": "^[A-Za-z]{3}$", "financialCurrency": "^[A-Za-z]{3}$", "lastSplitFactor": r"^\d+(\.\d+)?[:/]\d+(\.\d+)?$", "run_id": r"^run_\d{8}T\d{6}Z$"}


def _text_rule(name: str, c: str):
    """True where a text that is not blank breaks its column's pattern."""
    v = F.col(f"`{c}`")
    if c in ("GradeDate", "snapshot_utc"):
        bad = utc_time(v).isNull()
    elif c == "source_date":
        bad = utc_day(v).isNull()
    elif c == "symbol":
        bad = ~norm_symbol(v).rlike("^[A-Z0-9]+(-[A-Z0-9]+)?$")
    elif c == "dataset":
        bad = strip(v) != name
    elif c in PATTERNS:
        bad = ~strip(v).rlike(PATTERNS[c])
    else:
        bad = ~v.rlike(r"[\p{L}\p{N}]") | v.rlike(r"[\p{Cntrl}\x{FFFD}]")
    return ~is_blank(v) & bad


def _watched_tables(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, list[str]]]:
    out = {}
    for name in dict.fromkeys(t for t, _ in WATCHED):
        rows = table(spark, d, name).where(data_rows())
        out[name] = (rows, [c for c, k in rows.dtypes if k == "double"])
    return out


def _base(spark: SparkSession, d: str, wanted: dict[str, list[str]]) -> DataFrame:
    """Loads are trading_dates, for tables without one the days of source_date (as written where unreadable, '' where missing)."""
    counts = broken = None
    for name, columns in wanted.items():
        rows, load = table(spark, d, name), "trading_date"
        if "no_analyst_coverage" in rows.columns:
            rows = rows.where(data_rows())
        if load not in rows.columns:
            load, rows = "load", rows.withColumn("load", F.coalesce(utc_day("source_date").cast("string"), strip("source_date"), F.lit("")))
        kinds = dict(rows.dtypes)
        c = quality.value_counts(rows, name, columns, load)
        rules = {c: _text_rule(name, c) for c in columns if kinds[c] == "string"} | {c: r for c, r in _rules(name).items() if c in columns}
        counts = c if counts is None else counts.unionByName(c)
        if rules:
            v = quality.rule_violations(rows, name, rules, load)
            broken = v if broken is None else broken.unionByName(v)
    return quality.base_profile(counts, broken)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    base = _base(spark, d, {t: [c for u, c in WATCHED if u == t] for t, _ in WATCHED})
    issues = quality.load_issues(base, quality.drift(_watched_tables(spark, d)), WATCHED)
    return issues.select("table_name", "column_name", F.col("load").alias("trading_date"), "issue")


PROFILED = ["analyst_price_targets", "recommendations", "estimates", "profile", "upgrades_downgrades", "finra_short_volume", "cftc_tff_positioning"]


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    """Every column of the large tables per trading_date (FINRA and CFTC: source_date). violations is null where no rule is checked."""
    out = _base(spark, d, {name: [c for c in table(spark, d, name).columns if c != "trading_date"] for name in PROFILED})
    return out.select("table_name", F.col("load").alias("trading_date"), "column_name", "n_rows", "n_missing", "n_distinct", "least", "greatest", "first_text", "last_text", "mode_count", "median", "violations")


def p3_drift(spark: SparkSession, d: str) -> DataFrame:
    """Cross-fitted discrimination and ablation of every numeric column of the watched tables."""
    return quality.drift(_watched_tables(spark, d)).withColumnRenamed("load", "trading_date")


def _p3_sql() -> str:
    bad = {
        "profile": "v < 0 OR v > 1",
        "recommendations": "v < 0 OR v > 500",
        "analyst_price_targets": "isinf(v) OR v <= 0 OR coalesce(v < lo, false) OR coalesce(v > hi, false)",
    }
    parts = []
    for t, c in WATCHED:
        lohi = f"{_present_sql('low')} AS lo, {_present_sql('high')} AS hi" if t == "analyst_price_targets" else "NULL AS lo, NULL AS hi"
        parts.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, trading_date, v, {bad[t]} AS bad FROM (SELECT trading_date, {_present_sql(c)} AS v, {lohi} FROM {t} WHERE NOT coalesce(no_analyst_coverage, false))""")
    return f"""WITH r AS ({' UNION ALL '.join(parts)}),
        m AS (SELECT table_name, column_name, trading_date, max(c) AS mode_n FROM (SELECT table_name, column_name, trading_date, round(v, 6) AS x, count(*) AS c FROM r WHERE v IS NOT NULL GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
        b AS (SELECT table_name, column_name, trading_date, count(*) AS n, count(v) AS given, count(CASE WHEN bad THEN 1 END) AS broken, median(CASE WHEN NOT isinf(v) THEN v END) AS med FROM r GROUP BY 1, 2, 3),
        p AS (SELECT *, coalesce(mode_n * 1.0 / nullif(given, 0), 0) AS mode_share, 1 - given * 1.0 / n AS missing FROM b LEFT JOIN m USING (table_name, column_name, trading_date)),
        q AS (SELECT *, lag(missing) OVER w AS missing0, lag(med) OVER w AS med0, lag(mode_share) OVER w AS mode0 FROM p WINDOW w AS (PARTITION BY table_name, column_name ORDER BY trading_date))
        SELECT table_name, column_name, trading_date, 'range' AS issue FROM q WHERE broken > 0
        UNION ALL SELECT table_name, column_name, trading_date, 'nulls' FROM q WHERE missing - missing0 > 0.2
        UNION ALL SELECT table_name, column_name, trading_date, 'level' FROM q WHERE med > 3 * med0 OR med < med0 / 3
        UNION ALL SELECT table_name, column_name, trading_date, 'heaping' FROM q WHERE mode_share - mode0 > 0.25"""


_COMMON = {"row_id": "num", "symbol": "txt", "snapshot_utc": "txt", "dataset": "txt", "run_id": "txt", "no_analyst_coverage": "bool"}
_MARKET = {"row_id": "num", "report_id": "num", "symbol": "txt", "snapshot_utc": "txt", "dataset": "txt", "run_id": "txt", "source_date": "txt", "source_url": "txt", "source_sha256": "txt", "source_lag_days": "num"}
_KINDS = {
    "analyst_price_targets": _COMMON | dict.fromkeys(TARGET_VALUES, "num"),
    "recommendations": _COMMON | {"period": "txt"} | dict.fromkeys(RECOMMENDATION_VALUES, "num"),
    "estimates": _COMMON | dict.fromkeys(["estimate_table", "period", "currency"], "txt") | dict.fromkeys(ESTIMATE_VALUES, "num"),
    "profile": _COMMON | {c: "txt" if c in PROFILE_TEXT else "num" for c in PROFILE_FIELDS},
    "upgrades_downgrades": _COMMON | dict.fromkeys(["GradeDate", "Firm", "FromGrade", "ToGrade", "Action", "priceTargetAction"], "txt") | dict.fromkeys(["currentPriceTarget", "priorPriceTarget"], "num"),
    "finra_short_volume": _MARKET | dict.fromkeys(FINRA_NUMBERS, "num") | {"market": "txt"},
    "cftc_tff_positioning": _MARKET | dict.fromkeys(CFTC_TEXT, "txt") | dict.fromkeys([*CFTC_NUMBERS, *CFTC_NET_SHARES], "num"),
}


def _broken_sql(name: str, c: str, kind: str) -> str:
    """The rules of _rules and _text_rule; NULL where none is checked."""
    v, present_v = f'"{c}"', _present_sql(c)
    if (name, c) in WATCHED:
        return {
            "shortPercentOfFloat": f"{present_v} < 0 OR {present_v} > 1",
            "hold": f"{present_v} < 0 OR {present_v} > 500",
            "median": f"isinf({present_v}) OR {present_v} <= 0 OR coalesce({present_v} < {_present_sql('low')}, false) OR coalesce({present_v} > {_present_sql('high')}, false)",
        }[c]
    if kind != "txt":
        return "NULL"
    if c == "GradeDate":
        bad = f"{GRADE_TIME_SQL} IS NULL"
    elif c == "snapshot_utc":
        bad = "TRY_CAST(snapshot_utc AS TIMESTAMPTZ) IS NULL"
    elif c == "source_date":
        bad = "try_strptime(substr(regexp_replace(source_date, '[^0-9]', '', 'g'), 1, 8), '%Y%m%d') IS NULL"
    elif c == "symbol":
        bad = f"NOT regexp_matches({SYMBOL_SQL}, '^[A-Z0-9]+(-[A-Z0-9]+)?$')"
    elif c == "dataset":
        bad = f"trim(dataset) <> '{name}'"
    elif c in PATTERNS:
        bad = f"NOT regexp_matches(trim({v}), '{PATTERNS[c]}')"
    else:
        bad = rf"NOT regexp_matches({v}, '[\p{{L}}\p{{N}}]') OR regexp_matches({v}, '[\x00-\x1f\x7f\x{{FFFD}}]')"
    return rf"{v} IS NOT NULL AND NOT regexp_matches({v}, '^\s*$') AND ({bad})"


def _p3_profile_sql() -> str:
    parts = []
    for name in PROFILED:
        market = name in ("finra_short_volume", "cftc_tff_positioning")
        load = "coalesce(strftime(try_strptime(substr(regexp_replace(source_date, '[^0-9]', '', 'g'), 1, 8), '%Y%m%d'), '%Y-%m-%d'), trim(source_date), '')" if market else "trading_date"
        where = "" if market else " WHERE NOT coalesce(no_analyst_coverage, false)"
        for c, kind in _KINDS[name].items():
            num = f'CASE WHEN isnan(CAST("{c}" AS DOUBLE)) THEN NULL ELSE CAST("{c}" AS DOUBLE) END' if kind == "num" else "CAST(NULL AS DOUBLE)"
            txt = "CAST(NULL AS VARCHAR)" if kind == "num" else rf"""CASE WHEN regexp_matches(CAST("{c}" AS VARCHAR), '^\s*$') THEN NULL ELSE CAST("{c}" AS VARCHAR) END"""
            parts.append(f"SELECT '{name}' AS table_name, {load} AS trading_date, '{c}' AS column_name, {num} AS num, {txt} AS txt, CAST({_broken_sql(name, c, kind)} AS BOOLEAN) AS bad, {str(kind == 'txt' or (name, c) in WATCHED).lower()} AS ruled FROM {name}{where}")
    return f"""WITH r AS ({' UNION ALL '.join(parts)}),
        a AS (SELECT table_name, trading_date, column_name, count(*) AS n_rows, count(*) - count(num) - count(txt) AS n_missing, count(DISTINCT num) + count(DISTINCT txt) AS n_distinct, min(num) AS least, max(num) AS greatest, min(txt) AS first_text, max(txt) AS last_text,
                coalesce(list_max(map_values(histogram(round(num, 6)))), list_max(map_values(histogram(txt))), 0) AS mode_count, list_sort(list(num) FILTER (WHERE num IS NOT NULL AND NOT isinf(num))) AS l, CASE WHEN bool_or(ruled) THEN count(*) FILTER (WHERE bad) END AS violations FROM r GROUP BY 1, 2, 3)
        SELECT table_name, trading_date, column_name, n_rows, n_missing, n_distinct, least, greatest, first_text, last_text, CAST(mode_count AS BIGINT) AS mode_count, (l[(len(l) - 1) // 2 + 1] + l[len(l) // 2 + 1]) / 2 AS median, violations FROM a"""


# --- 5 ---------------------------------------------------------------------------------------------------------------


def _profile_versions(spark: SparkSession, d: str) -> DataFrame:
    return history.versions(snapshot_rows(spark, d, "profile"), ["sector", "industry"], ["sharesOutstanding", "floatShares"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _profile_versions(spark, d).select("symbol", "valid_from", "valid_to")


def p5_history(spark: SparkSession, d: str) -> DataFrame:
    """The versions with their attributes."""
    return _profile_versions(spark, d).select("symbol", "version", "valid_from", "valid_to", "sector", "industry", "sharesOutstanding", "floatShares")


def _p5_sql() -> str:
    def label(c: str) -> str:
        return f"lower(regexp_replace({c}, '[^a-zA-Z0-9]+', '', 'g'))"

    def key(c: str) -> str:
        return f"CASE WHEN {label(c)} IN ('', 'na', 'none', 'null', 'nan', 'unknown', 'notavailable') THEN NULL ELSE {label(c)} END"

    def num(c: str) -> str:
        return f"CASE WHEN isnan({c}) OR isinf({c}) THEN NULL ELSE {c} END"

    def written(c: str) -> str:
        return rf"CASE WHEN {key(c)} IS NOT NULL THEN regexp_replace({c}, '^\s+|\s+$', '', 'g') END"

    return f"""WITH one AS (SELECT * FROM (SELECT {SYMBOL_SQL} AS symbol, trading_date AS d, {key('sector')} AS a, {key('industry')} AS b, {written('sector')} AS aw, {written('industry')} AS bw, {num('"sharesOutstanding"')} AS x, {num('"floatShares"')} AS y,
            row_number() OVER (PARTITION BY {SYMBOL_SQL}, trading_date ORDER BY {AT_SQL} DESC, row_id) AS rn FROM profile WHERE NOT coalesce(no_analyst_coverage, false)) WHERE rn = 1 AND symbol IS NOT NULL AND d IS NOT NULL),
        k AS (SELECT symbol, d, {', '.join(f'last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}' for c in ('a', 'b', 'aw', 'bw', 'x', 'y'))} FROM one),
        l AS (SELECT *, row_number() OVER w AS nr, {', '.join(f'lag({c}) OVER w AS {c}0' for c in 'abxy')} FROM k WINDOW w AS (PARTITION BY symbol ORDER BY d)),
        s AS (SELECT symbol, d, aw, bw, x, y FROM l WHERE nr = 1 OR a IS DISTINCT FROM a0 OR b IS DISTINCT FROM b0 OR {' OR '.join(f'({c} IS NULL) <> ({c}0 IS NULL) OR abs({c} - {c}0) > 1e-6 * greatest(abs({c}), abs({c}0))' for c in 'xy')})
        SELECT symbol, row_number() OVER w AS version, d AS valid_from, coalesce(lead(d) OVER w, '9999-12-31') AS valid_to, aw AS sector, bw AS industry, x AS "sharesOutstanding", y AS "floatShares" FROM s WINDOW w AS (PARTITION BY symbol ORDER BY d)"""


# --- 6 ---------------------------------------------------------------------------------------------------------------


def profile_timeline(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Rating actions and profile rows as events and versions of the as-of join."""
    events = table(spark, d, "upgrades_downgrades").where(data_rows()).select(norm_symbol("symbol").alias("entity"), F.unix_micros(utc_time("GradeDate")).alias("t"), F.col("row_id").alias("event_id"))
    rank = F.struct("trading_date", F.unix_micros("at").alias("at"), (-F.col("row_id")).alias("rid"))
    rows = snapshot_rows(spark, d, "profile").where("trading_date is not null")
    return events, rows.select(F.col("symbol").alias("entity"), F.unix_micros("at").alias("t"), rank.alias("rank"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return asof_join.as_known(*profile_timeline(spark, d)).select(F.col("event_id").alias("row_id"), (-F.col("best.rid")).alias("profile_row_id"))


def p6_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Each rating action with the sector and market value known at its time; only the matched ids meet the profile again."""
    found = p6_found(spark, d)
    attrs = table(spark, d, "profile").select(F.col("row_id").alias("profile_row_id"), "sector", "marketCap")
    return found.join(attrs, "profile_row_id").select("row_id", "profile_row_id", "sector", F.col("marketCap").alias("market_cap"))


GRADE_TIME_SQL = """TRY_CAST(CASE WHEN NOT contains(trim(GradeDate), ':') THEN substr(trim(GradeDate), 1, 10) || 'T00:00:00Z'
            WHEN regexp_matches(trim(GradeDate), '([zZ]|[+-][0-9]{2}:?[0-9]{2})$') THEN trim(GradeDate) ELSE trim(GradeDate) || 'Z' END AS TIMESTAMPTZ)"""


def _p6_sql() -> str:
    return f"""SELECT row_id, profile_row_id FROM (SELECT e.row_id AS row_id, p.row_id AS profile_row_id, row_number() OVER (PARTITION BY e.row_id ORDER BY p.trading_date DESC, p.at DESC, p.row_id) AS rn
        FROM (SELECT row_id, {SYMBOL_SQL} AS symbol, {GRADE_TIME_SQL} AS t FROM upgrades_downgrades WHERE NOT coalesce(no_analyst_coverage, false)) e
        JOIN (SELECT row_id, trading_date, {SYMBOL_SQL} AS symbol, {AT_SQL} AS at FROM profile WHERE NOT coalesce(no_analyst_coverage, false)) p
        ON e.symbol = p.symbol AND p.at <= e.t) WHERE rn = 1"""


QUERIES = {
    "p1_found": p1_found, "p1_change_counts": p1_change_counts, "p2_found": p2_found, "p2_totals": p2_totals, "p2_sliding_totals": p2_sliding_totals, "p2_left_out": p2_left_out, "p3_found": p3_found, "p3_profile": p3_profile, "p3_drift": p3_drift,
    "p5_found": p5_found, "p5_history": p5_history, "p6_found": p6_found, "p6_attributes": p6_attributes,
}
SQL = {"p1_found": _p1_sql(), "p2_found": _p2_sql(), "p2_totals": _p2_totals_sql(), "p2_sliding_totals": _p2_sliding_sql(), "p2_left_out": _p2_left_out_sql(), "p3_found": _p3_sql(), "p3_profile": _p3_profile_sql(), "p5_history": _p5_sql(), "p6_found": _p6_sql()}
SQL["p5_found"] = f"SELECT symbol, valid_from, valid_to FROM ({SQL['p5_history']})"
SQL["p1_change_counts"] = f"SELECT table_name, trading_date, change_kind, count(*) AS n_records FROM ({SQL['p1_found']}) GROUP BY 1, 2, 3"
SQL["p6_attributes"] = f'SELECT f.row_id AS row_id, f.profile_row_id AS profile_row_id, q.sector AS sector, q."marketCap" AS market_cap FROM ({SQL["p6_found"]}) f JOIN profile q ON q.row_id = f.profile_row_id'
