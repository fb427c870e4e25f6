"""The archive's own operators over the star-schema test tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import data_rows, norm_symbol, utc_time
from ..operators import asof, prices
from ..schemas import CFTC_SHARES, ESTIMATE_NUMBERS, METADATA_COLUMNS
from ..session import table
from ..sources import feeds
from .changes import AT_SQL, SYMBOL_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- scans, filters and latest values --------------------------------------------------------------------------------


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events
    WHERE ts <= TIMESTAMP '2024-01-20 12:00:00' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20') WHERE rn = 1""")
def latest_as_of_events(spark: SparkSession, d: str) -> DataFrame:
    """Last event per user and type known at noon of a day, from ten days back."""
    ts = F.col("ts")
    e = table(spark, d, "events").where((ts >= F.lit("2024-01-10").cast("timestamp_ntz")) & (ts <= F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")))
    return asof.latest_per_key(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query(f"""SELECT {SYMBOL_SQL} AS symbol, period, trading_date, buy, hold FROM (SELECT *, row_number() OVER (PARTITION BY {SYMBOL_SQL}, period ORDER BY {AT_SQL} DESC, trading_date DESC, row_id DESC) AS rn FROM recommendations
    WHERE NOT coalesce(no_analyst_coverage, false) AND {AT_SQL} <= TIMESTAMPTZ '2026-07-20 12:00:00+00' AND trading_date BETWEEN '2026-07-10' AND '2026-07-20') WHERE rn = 1""")
def latest_recommendations(spark: SparkSession, d: str) -> DataFrame:
    """Latest recommendations per symbol and period that were known at a time; markers never hide a value."""
    r = table(spark, d, "recommendations").where(data_rows() & F.col("trading_date").between("2026-07-10", "2026-07-20"))
    r = r.withColumn("symbol", norm_symbol("symbol")).withColumn("at", utc_time("snapshot_utc")).where(F.col("at") <= F.lit("2026-07-20T12:00:00Z").cast("timestamp"))
    return asof.latest_per_key(r, ["symbol", "period"], ["at", "trading_date", "row_id"]).select("symbol", "period", "trading_date", "buy", "hold")


@query("SELECT o_orderstatus, count(*) AS n, strftime(min(o_orderdate), '%Y-%m-%d') AS first_date, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date FROM orders GROUP BY 1")
def partition_summary(spark: SparkSession, d: str) -> DataFrame:
    """Count, first and last date of each part."""
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("first_date"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_date"))


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-01')""")
def latest_report(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the latest date not after a day. The one-row maximum is the only thing broadcast."""
    o = table(spark, d, "orders").where(F.col("o_orderdate") <= F.lit("1996-06-01").cast("timestamp_ntz"))
    return o.join(F.broadcast(o.agg(F.max("o_orderdate").alias("o_orderdate"))), "o_orderdate").select("o_orderkey", "o_orderstatus")


# --- events ------------------------------------------------------------------------------------------------------------


@query("SELECT user_id, event_type, min(ts) AS first_seen FROM events GROUP BY 1, 2")
def first_seen_events(spark: SparkSession, d: str) -> DataFrame:
    """First sight of each key."""
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("ts").alias("first_seen"))






@query("""SELECT user_id, event_type, value FROM (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY p DESC, ts DESC, event_id DESC) AS rn FROM
    (SELECT *, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 1 ELSE 0 END AS p FROM events)) WHERE rn = 1""")
def upsert_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Newer rows overlay older ones by key."""
    e = table(spark, d, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    last = lambda df: asof.latest_per_key(df, ["user_id", "event_type"], ["ts", "event_id"])
    return asof.overlay(last(e.where(F.col("ts") < cut)), last(e.where(F.col("ts") >= cut)), ["user_id", "event_type"]).select("user_id", "event_type", "value")


_WIN = "SELECT user_id, event_type FROM events WHERE ts >= TIMESTAMP '{}' AND ts < TIMESTAMP '{}'"


@query(f"""SELECT user_id, event_type, 'removed' AS side FROM ({_WIN.format('2024-01-01', '2024-01-11')} EXCEPT ALL {_WIN.format('2024-01-11', '2024-01-21')})
    UNION ALL SELECT user_id, event_type, 'added' AS side FROM ({_WIN.format('2024-01-11', '2024-01-21')} EXCEPT ALL {_WIN.format('2024-01-01', '2024-01-11')})""")
def restatement_diff(spark: SparkSession, d: str) -> DataFrame:
    """Rows that one of two loads has more often than the other."""
    e = table(spark, d, "events")
    part = lambda a, b: e.where((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz"))).select("user_id", "event_type")
    return asof.restatements(part("2024-01-01", "2024-01-11"), part("2024-01-11", "2024-01-21"))


@query("""SELECT p.event_id AS purchase_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def asof_join_orders_events(spark: SparkSession, d: str) -> DataFrame:
    """Each purchase with the latest view before it: a union and a running last value, no range join."""
    from ..operators.asof_join import as_known

    e = table(spark, d, "events").select(F.col("user_id").alias("entity"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id", "event_type")
    views = e.where("event_type = 'view'").select("entity", "t", F.struct("t", "event_id").alias("rank"))
    return as_known(e.where("event_type = 'purchase'"), views).select(F.col("event_id").alias("purchase_id"), F.col("best.event_id").alias("view_id"))


# --- payloads, names and values ----------------------------------------------------------------------------------------


@query("""SELECT c_custkey AS id, 'customer' AS source_table, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, 'supplier', s_acctbal FROM supplier""")
def tagged_union(spark: SparkSession, d: str) -> DataFrame:
    """Tables of one kind united, with the table's name in a column."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("source_table"), F.col("c_acctbal").alias("balance"))
    return c.unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("source_table"), F.col("s_acctbal").alias("balance")))


@query("SELECT row_id, symbol, CASE WHEN isnan(median) OR isinf(median) THEN NULL ELSE median END AS median, CAST(NULL AS VARCHAR) AS currency FROM analyst_price_targets")
def schema_conform(spark: SparkSession, d: str) -> DataFrame:
    """Missing columns as typed nulls, non-finite numbers as null."""
    from ..sources.sinks import finite_or_null

    return table(spark, d, "analyst_price_targets").select("row_id", "symbol", finite_or_null(F.col("median"), False).alias("median"), F.lit(None).cast("string").alias("currency"))


@query("SELECT o_custkey, string_agg(o_orderstatus, ', ' ORDER BY o_orderkey) AS statuses FROM orders GROUP BY 1")
def list_flatten(spark: SparkSession, d: str) -> DataFrame:
    """A list per key flattened to text, in order."""
    g = table(spark, d, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("l"))
    return g.select("o_custkey", F.array_join(F.transform("l", lambda x: x["o_orderstatus"]), ", ").alias("statuses"))


@query("SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus || '|' || o_orderpriority) AS row_hash FROM orders")
def row_identity_hash(spark: SparkSession, d: str) -> DataFrame:
    """SHA-256 over a row's identifying columns."""
    return table(spark, d, "orders").select("o_orderkey", F.sha2(F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), 256).alias("row_hash"))


_DATA_FIELDS = [c for c in ESTIMATE_NUMBERS]


@query(f"""SELECT trading_date, count(DISTINCT {SYMBOL_SQL}) AS n_symbols FROM estimates WHERE NOT coalesce(no_analyst_coverage, false) AND (coalesce(currency, '') <> '' OR {' OR '.join(f'"{c}" IS NOT NULL' for c in _DATA_FIELDS)}) GROUP BY 1""")
def data_bearing(spark: SparkSession, d: str) -> DataFrame:
    """Symbols with a value besides keys and metadata, by date."""
    from ..operators.normalize import data_bearing as bearing

    e = bearing(table(spark, d, "estimates").where(data_rows()), METADATA_COLUMNS | {"row_id"})
    return e.groupBy("trading_date").agg(F.count_distinct(norm_symbol("symbol")).alias("n_symbols"))


# --- universe and coverage ---------------------------------------------------------------------------------------------


_Q1 = "SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-04-01'"


def _quarter(spark: SparkSession, d: str) -> DataFrame:
    at = F.col("o_orderdate")
    return table(spark, d, "orders").where((at >= F.lit("1996-01-01").cast("timestamp_ntz")) & (at < F.lit("1996-04-01").cast("timestamp_ntz"))).select(F.col("o_custkey").alias("c_custkey")).distinct()


@query(f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN ({_Q1})")
def missing_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Expected keys that a period lacks."""
    return table(spark, d, "customer").select("c_custkey").join(_quarter(spark, d), "c_custkey", "left_anti")


@query(f"SELECT c_mktsegment, count(*) AS expected, count(CASE WHEN c_custkey IN ({_Q1}) THEN 1 END) AS covered, round(count(CASE WHEN c_custkey IN ({_Q1}) THEN 1 END) * 1.0 / count(*), 4) AS ratio FROM customer GROUP BY 1")
def coverage_by_segment(spark: SparkSession, d: str) -> DataFrame:
    """Share of expected keys that a period covers."""
    seen = _quarter(spark, d).withColumn("seen", F.lit(True))
    c = table(spark, d, "customer").join(seen, "c_custkey", "left").groupBy("c_mktsegment").agg(F.count("*").alias("expected"), F.count_if(F.coalesce("seen", F.lit(False))).alias("covered"))
    return c.withColumn("ratio", F.round(F.col("covered") / F.col("expected"), 4))


@query("""WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-16'), b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-15'),
    c AS (SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15') SELECT user_id FROM a WHERE user_id NOT IN (SELECT user_id FROM b) AND user_id IN (SELECT user_id FROM c)""")
def newly_uncovered(spark: SparkSession, d: str) -> DataFrame:
    """(A - B) intersect C over consecutive days."""
    from ..operators.coverage import newly_uncovered as lost

    e = table(spark, d, "events").select(F.col("user_id").alias("symbol"), (F.col("event_type") == "error").alias("no_analyst_coverage"), F.to_date("ts").alias("day"))
    on = lambda x: e.where(F.col("day") == F.lit(x).cast("date"))
    return lost(on("2024-01-16"), on("2024-01-15")).select(F.col("symbol").alias("user_id"))


@query("SELECT array_to_string(list_sort(list(DISTINCT n_name))[1:10], ',') AS sample, count(DISTINCT n_name) - 10 AS left_out FROM nation")
def truncated_sample(spark: SparkSession, d: str) -> DataFrame:
    """The first names in order and how many more there are."""
    s = F.sort_array(F.collect_set("n_name"))
    return table(spark, d, "nation").agg(F.array_join(F.slice(s, 1, 10), ",").alias("sample"), (F.count_distinct("n_name") - 10).alias("left_out"))


@query("SELECT dataset, count(*) AS rows_written, count(CASE WHEN no_analyst_coverage THEN 1 END) AS no_coverage, count(DISTINCT symbol) AS symbols FROM (SELECT dataset, symbol, no_analyst_coverage FROM profile UNION ALL SELECT dataset, symbol, no_analyst_coverage FROM estimates) GROUP BY 1")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of a run's manifest by dataset."""
    from ..operators.coverage import run_counters as counters

    cols = ["dataset", "symbol", "no_analyst_coverage"]
    return counters(table(spark, d, "profile").select(*cols).unionByName(table(spark, d, "estimates").select(*cols)))


# --- bars and the row contract -----------------------------------------------------------------------------------------


@query("""SELECT event_type, strftime(ts, '%Y-%m-%d') AS bar_session, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1, 2""")
def daily_ohlc_bars(spark: SparkSession, d: str) -> DataFrame:
    """Open, high, low and close by day, in one aggregation."""
    at = F.struct("ts", "event_id")
    return table(spark, d, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("bar_session")).agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"))


@query("SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS session_date FROM events ORDER BY 1 DESC LIMIT 20")
def session_axis_last20(spark: SparkSession, d: str) -> DataFrame:
    """The last 20 distinct days."""
    return table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("session_date")).distinct().orderBy(F.desc("session_date")).limit(20)


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE abs(l_quantity * (l_extendedprice / l_quantity) - l_extendedprice) <= greatest(1e-10 * greatest(abs(l_quantity * (l_extendedprice / l_quantity)), abs(l_extendedprice)), 1e-10)
    AND l_extendedprice >= greatest(l_discount, l_tax, l_quantity) AND l_tax <= least(l_discount, l_extendedprice, l_quantity)""")
def ohlc_envelope(spark: SparkSession, d: str) -> DataFrame:
    """Factor parity within a tolerance, and an envelope that holds all values."""
    e, q = F.col("l_extendedprice"), F.col("l_quantity")
    ok = prices.close_to(q * (e / q), e) & prices.valid_envelope(F.col("l_discount"), e, F.col("l_tax"), q)
    return table(spark, d, "lineitem").where(ok).select("l_orderkey", "l_linenumber")


@query("SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)")
def duplicate_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Rows that repeat a key."""
    return asof.duplicate_pairs(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT p_partkey, CAST(floor((row_number() OVER (ORDER BY p_partkey) - 1) / 50) + 1 AS BIGINT) AS batch_no FROM part")
def batch_number(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 50 in order, numbered without a global sort in one task."""
    return asof.batch_number(table(spark, d, "part").select("p_partkey"), "p_partkey", 50)


@query("SELECT coalesce(bool_and(o_orderkey >= prev), true) AS in_order FROM (SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS prev FROM orders) WHERE prev IS NOT NULL")
def sortedness_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether rows stand in canonical order."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("row_no"), F.col("o_orderkey").alias("canonical_symbol"), F.lit(0).alias("bar_session"))
    return prices.sortedness(o)


# --- market context ------------------------------------------------------------------------------------------------------


@query("SELECT row_id, CASE WHEN total_volume > 0 THEN short_volume / total_volume END AS ratio FROM finra_short_volume")
def short_volume_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Short over total volume where there is any."""
    return table(spark, d, "finra_short_volume").select("row_id", feeds.short_ratio(F.col("short_volume"), F.col("total_volume")).alias("ratio"))


@query("SELECT row_id, " + ", ".join(f"({p}_long - {p}_short) / nullif(open_interest, 0) AS {p}_net_share" for p in CFTC_SHARES) + " FROM cftc_tff_positioning")
def net_share(spark: SparkSession, d: str) -> DataFrame:
    """Net positions over open interest."""
    return table(spark, d, "cftc_tff_positioning").select("row_id", *[feeds.net_share(p).alias(f"{p}_net_share") for p in CFTC_SHARES])


@query("SELECT market, count(*) AS n, count(DISTINCT source_date) AS dates, CAST(count(DISTINCT dataset) = 1 AS BOOLEAN) AS uniform FROM cftc_tff_positioning GROUP BY 1")
def uniformity(spark: SparkSession, d: str) -> DataFrame:
    """Uniformity checks in one aggregate per group."""
    return table(spark, d, "cftc_tff_positioning").groupBy("market").agg(F.count("*").alias("n"), F.count_distinct("source_date").alias("dates"), (F.count_distinct("dataset") == 1).alias("uniform"))


@query("SELECT l_returnflag, l_linestatus, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS label, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2")
def code_labels(spark: SparkSession, d: str) -> DataFrame:
    """Codes to labels through a literal map."""
    m = F.create_map(*[F.lit(x) for x in ("A", "accepted", "N", "none", "R", "returned")])
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty")).withColumn("label", F.try_element_at(m, F.col("l_returnflag")))

