"""Daily bars: reshape, adjust, row contract, coverage, eligibility."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec

from ..schemas import PRICE_ANCHORS, PRICE_NUMBERS

# Fixed values of the row contract
CONSTANTS = {"dataset": "daily_prices", "provider_name": "yahoo", "transport": "yfinance", "currency": "USD", "unadjusted_price_basis": "raw_unadjusted", "adjusted_price_basis": "fully_adjusted"}
BAR_FIELDS = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Adj Close": "adj_close", "Volume": "volume", "Dividends": "dividend_cash", "Stock Splits": "stock_split_ratio"}
ZONED = r"(Z|[+-]\d{2}:\d{2})$"
MOST_ERRORS = 500


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def close_to(a: Column, b: Column, tolerance: float = 1e-10) -> Column:
    """Equal within a relative or absolute tolerance."""
    return F.abs(a - b) <= F.greatest(tolerance * F.greatest(F.abs(a), F.abs(b)), F.lit(tolerance))


def valid_envelope(o: Column, h: Column, low: Column, c: Column) -> Column:
    return (h >= F.greatest(low, o, c)) & (low <= F.least(h, o, c))


def long_bars(wide: DataFrame, session: str = "Date") -> DataFrame:
    """Columns '<ticker>|<field>' of a wide vendor frame to (bar_session, provider_symbol, open, ..., stock_split_ratio)."""
    tickers: dict[str, dict[str, str]] = {}
    by_field = {k.lower(): v for k, v in BAR_FIELDS.items()}
    for c in wide.columns:
        if "|" in c:
            a, b = c.split("|", 1)
            ticker, field = (a, b) if b.lower() in by_field else (b, a)
            if field.lower() in by_field:
                tickers.setdefault(ticker.upper(), {})[by_field[field.lower()]] = c
    cell = lambda t, f: F.col(f"`{tickers[t][f]}`").cast("double") if f in tickers[t] else F.lit(None).cast("double")
    each = F.array(*[F.struct(F.lit(t).alias("provider_symbol"), *[cell(t, f).alias(f) for f in BAR_FIELDS.values()]) for t in sorted(tickers)])
    return wide.select(F.to_date(session).alias("bar_session"), F.explode(each).alias("x")).select("bar_session", "x.*")


def adjust(bars: DataFrame) -> DataFrame:
    """Adjusted prices by the factor adj_close / close; the envelope is widened to hold what rounding pushed out of it. No split is null."""
    f = F.try_divide("adj_close", "close")
    out = bars.withColumn("adjustment_factor", f)
    o, c = F.col("open") * F.col("adjustment_factor"), F.col("adj_close")
    out = out.withColumns({"adjusted_open": o, "adjusted_close": c, "adjusted_high": F.greatest(F.col("high") * F.col("adjustment_factor"), o, c), "adjusted_low": F.least(F.col("low") * F.col("adjustment_factor"), o, c)})
    return out.withColumn("stock_split_ratio", F.nullif("stock_split_ratio", F.lit(0.0)))


def usable_bars(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Bars on the session axis with all required fields finite; reject_reason is set where the close is zero."""
    on_axis = bars.join(F.broadcast(sessions.select(F.col("session_date").alias("bar_session"))), "bar_session", "left_semi")
    whole = on_axis
    for c in ("open", "high", "low", "close", "adj_close", "volume"):
        whole = whole.where(is_finite(F.col(c)))
    return whole.withColumn("reject_reason", F.when(F.col("close") == 0, "zero_close"))


def canonical_json(record: dict) -> str:
    """Sorted keys, no blanks, no NaN."""
    return json.dumps(record, sort_keys=True, separators=(",", ":"), allow_nan=False)


def with_record_hash(rows: DataFrame, column: str = "raw_record_sha256") -> DataFrame:
    """SHA-256 of the canonical JSON of a raw bar. Python writes the numbers, for the JVM spells doubles otherwise; rows stay where they are."""
    kept = [c for c in rows.columns if c != column]
    schema = ", ".join([*[f"`{c}` {t}" for c, t in rows.dtypes if c != column], f"`{column}` string"])
    hashed = ("canonical_symbol", "bar_session", "unadjusted_open", "unadjusted_high", "unadjusted_low", "unadjusted_close", "volume")

    def digest(values: tuple) -> str | None:
        if None in values:
            return None
        symbol, day, o, h, low, c, v = values
        record = {"provider": CONSTANTS["provider_name"], "symbol": symbol, "date": day.isoformat(), "open": o, "high": h, "low": low, "close": c, "volume": v, "price_basis": CONSTANTS["unadjusted_price_basis"]}
        try:
            return hashlib.sha256(canonical_json(record).encode()).hexdigest()
        except ValueError:  # NaN and infinities have no JSON
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [digest(x) for x in zip(*[batch.column(c).to_pylist() for c in hashed], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(digests, pa.string())], names=[*kept, column])

    return rows.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)


def contract_errors(rows: DataFrame, target: date, close_utc: str, observed_utc: str, manifest: tuple[str, str] | None = None, check_hash: bool = True) -> DataFrame:
    """rows with errors array<string>: one name for each rule a row breaks. All rules are columns of one projection; the hash adds one Arrow stage."""
    stamp = lambda c: F.when(F.col(c).rlike(ZONED), F.col(c)).try_cast("timestamp")
    start, finish, known = stamp("capture_started_utc"), stamp("capture_finished_utc"), stamp("available_at_utc")
    at = lambda s: F.lit(s).cast("timestamp")
    numeric = F.lit(True)
    for c in PRICE_NUMBERS:
        numeric = numeric & is_finite(F.col(c))
    raw, adj = ([F.col(f"{b}_{x}") for x in ("open", "high", "low", "close")] for b in ("unadjusted", "adjusted"))
    rules: list[tuple[str, Column]] = [(f"{c}_is_not_{v}", ~F.col(c).eqNullSafe(F.lit(v))) for c, v in CONSTANTS.items()]
    rules += [
        ("is_target_session", ~F.col("is_target_session").eqNullSafe(F.coalesce(F.col("bar_session") == F.lit(target), F.lit(False)))),
        ("timestamp_without_zone", start.isNull() | finish.isNull() | known.isNull()),
        ("started_before_close", start < at(close_utc)), ("finished_before_start", finish < start), ("available_is_not_finish", known != finish), ("observed_before_available", known > at(observed_utc)),
        ("numbers_not_finite", ~numeric),
        ("price_not_positive", numeric & (F.least(*raw, *adj) <= 0)),
        ("negative_volume_or_factor", numeric & ((F.col("volume") < 0) | (F.col("adjustment_factor") <= 0))),
        ("raw_envelope", numeric & ~valid_envelope(*raw)), ("adjusted_envelope", numeric & ~valid_envelope(*adj)),
        *[(f"factor_parity_{n}", numeric & ~close_to(r * F.col("adjustment_factor"), a)) for n, r, a in zip(("open", "high", "low", "close"), raw, adj, strict=True)],
        ("negative_dividend", F.col("dividend_cash") < 0), ("split_not_positive", F.col("stock_split_ratio") <= 0),
    ]
    if manifest:
        rules.append(("outside_manifest", (start < at(manifest[0])) | (finish > at(manifest[1]))))
    if check_hash:
        rows = with_record_hash(rows, "__hash")
        rules.append(("raw_record_hash", numeric & ~F.col("raw_record_sha256").eqNullSafe(F.col("__hash"))))
    # The clamp of adjusted prices may leave the exact factor by rounding, within the tolerance of the parity rules
    return rows.withColumn("errors", F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]))).drop("__hash")


def error_sample(checked: DataFrame, most: int = MOST_ERRORS) -> DataFrame:
    """At most `most` messages 'SYMBOL session: rule', in order."""
    each = checked.select("canonical_symbol", "bar_session", F.explode("errors").alias("rule"))
    return each.select(F.concat(F.col("canonical_symbol"), F.lit(" "), F.col("bar_session").cast("string"), F.lit(": "), F.col("rule")).alias("message")).orderBy("message").limit(most)


def coverage(rows: DataFrame, requested: DataFrame, sessions: DataFrame, target: date, anchors: Sequence[str] = tuple(PRICE_ANCHORS)) -> DataFrame:
    """One row of counts: requested, with target, with the whole axis, anchors of either kind, missing, duplicate pairs, ratio (not rounded)."""
    n_axis = sessions.count()
    req = requested.select(F.col("symbol").alias("canonical_symbol")).distinct().withColumn("asked", F.lit(True))
    onto = rows.join(F.broadcast(sessions.select(F.col("session_date").alias("bar_session")).withColumn("on_axis", F.lit(True))), "bar_session", "left")
    per = onto.groupBy("canonical_symbol").agg(
        F.count("*").alias("n"), F.count_distinct("bar_session").alias("pairs"), F.count_distinct(F.when(F.col("on_axis"), F.col("bar_session"))).alias("on_axis"),
        F.coalesce(F.bool_or(F.col("bar_session") == F.lit(target)), F.lit(False)).alias("has_target"), F.count_if(F.col("bar_session") == F.lit(target)).alias("target_rows"),
    )
    both = per.join(req, "canonical_symbol", "full_outer").withColumn("anchor", F.col("canonical_symbol").isin(*anchors))
    hit = F.coalesce("asked", F.lit(False)) & F.coalesce("has_target", F.lit(False))
    return both.agg(
        F.count_if("asked").alias("requested_symbols"), F.count_if(hit).alias("symbols_with_target"), F.count_if(F.coalesce("asked", F.lit(False)) & (F.col("on_axis") == n_axis)).alias("symbols_with_full_axis"),
        F.count_if(F.col("anchor") & hit).alias("anchors_with_target"), F.count_if(F.col("anchor") & (F.col("on_axis") == n_axis)).alias("anchors_with_full_axis"), F.count_if(F.coalesce("asked", F.lit(False)) & ~hit).alias("missing_symbols"),
        F.count_if(F.col("asked").isNull()).alias("unknown_symbols"), F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"), F.coalesce(F.sum(F.col("n") - F.col("target_rows")), F.lit(0)).alias("history_rows"),
        F.coalesce(F.sum(F.col("n") - F.col("pairs")), F.lit(0)).alias("duplicate_pairs"), F.coalesce(F.try_divide(F.count_if(hit), F.count_if("asked")), F.lit(0.0)).alias("ratio"),
    )


def eligible(rows: DataFrame, sessions: DataFrame, target: date, anchors: Sequence[str] = tuple(PRICE_ANCHORS)) -> DataFrame:
    """Symbols that may be published: anchors need every session of the axis (relational division), others the target."""
    axis = rows.join(F.broadcast(sessions.select(F.col("session_date").alias("bar_session"))), "bar_session", "left_semi")
    per = axis.groupBy("canonical_symbol").agg(F.count_distinct("bar_session").alias("n"), F.bool_or(F.col("bar_session") == F.lit(target)).alias("has_target"))
    return per.where(F.when(F.col("canonical_symbol").isin(*anchors), F.col("n") == sessions.count()).otherwise(F.col("has_target"))).select("canonical_symbol")


def build_rows(bars: DataFrame, symbols: DataFrame, sessions: DataFrame, target: date, stamps: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows in contract form, rejected bars): symbols(symbol, provider_symbol) name the canonical symbol of each bar."""
    usable = usable_bars(bars, sessions).join(symbols.select(F.col("symbol").alias("canonical_symbol"), "provider_symbol"), "provider_symbol")
    rejected = usable.where("reject_reason is not null").select("canonical_symbol", "bar_session", F.col("reject_reason").alias("reason"))
    good = adjust(usable.where("reject_reason is null"))
    good = good.withColumnsRenamed({x: f"unadjusted_{x}" for x in ("open", "high", "low", "close")})
    consts = {**{k: F.lit(v) for k, v in CONSTANTS.items()}, **{k: F.lit(v) for k, v in stamps.items()}}
    good = good.withColumns({**consts, "symbol": F.col("canonical_symbol"), "target_session": F.lit(target), "is_target_session": F.col("bar_session") == F.lit(target)})
    from ..schemas import SCHEMAS

    good = with_record_hash(good.drop("adj_close", "reject_reason"))
    missing = [f for f in SCHEMAS["daily_prices"].fields if f.name not in good.columns]
    return good.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(*SCHEMAS["daily_prices"].fieldNames()).sort("canonical_symbol", "bar_session"), rejected


def sortedness(rows: DataFrame, position: str = "row_no", width: int = 100_000) -> DataFrame:
    """Whether rows stand in canonical order: one row, in_order BOOLEAN.

    Neighbours are compared within ranges of `width` positions, then the edges of ranges within ranges of ranges; what is left, a row for each width^2 positions, meets in one window.
    """
    key = F.struct("canonical_symbol", "bar_session")
    runs = rows.select(F.col(position).cast("long").alias("at"), key.alias("first"), key.alias("last"), F.lit(True).alias("ok"))

    def joined(w: WindowSpec) -> Column:
        return F.col("ok") & F.coalesce(F.lag("last").over(w.orderBy("at")) <= F.col("first"), F.lit(True))

    for _ in range(2):
        part = F.floor(F.col("at") / width)
        runs = runs.withColumn("ok", joined(Window.partitionBy(part))).groupBy(part.alias("part")).agg(F.min_by("first", "at").alias("first"), F.max_by("last", "at").alias("last"), F.bool_and("ok").alias("ok")).withColumnRenamed("part", "at")
    return runs.withColumn("ok", joined(Window.partitionBy())).agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("in_order"))
