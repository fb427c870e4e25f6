"""Selecting symbols: security filter, market value floor, carry-over, set algebra on symbol lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..schemas import PRICE_ANCHORS

# Fixed value: names of securities without analyst coverage
NOT_EQUITY = r"(?i)\b(warrants?|rights?|units?|preferred|debenture|notes? due|contingent value|when[- ]issued|subordinated notes?)\b|%\s*(notes?|debentures?)"
LEAST_MARKET_CAP = 3e8


def is_equity(name: Column) -> Column:
    """False for null and empty names and for warrants, rights, units, preferreds and debt."""
    return F.coalesce((name != "") & ~name.rlike(NOT_EQUITY), F.lit(False))


def is_plain_symbol(symbol: Column) -> Column:
    s = strip(symbol)
    return F.coalesce((s != "") & ~s.rlike(r"[\^ ]"), F.lit(False))


def market_cap(text: Column) -> Column:
    """Dollars with commas and signs to double; anything else is 0."""
    return F.coalesce(F.regexp_replace(text.cast("string"), "[,$]", "").try_cast("double"), F.lit(0.0))


def listing_symbol(symbol: Column) -> Column:
    """Upper case, '/' and '.' as '-'."""
    return F.translate(F.upper(strip(symbol)), "/.", "--")


def select_symbols(listings: DataFrame, existing: DataFrame | None = None, floor: float = LEAST_MARKET_CAP) -> tuple[DataFrame, DataFrame]:
    """(symbols, funnel): listings(symbol, name, marketCap) that pass, with the symbols carried over; counts of every step in one row."""
    marked = listings.select(listing_symbol(F.col("symbol")).alias("symbol"), (is_equity(F.col("name")) & is_plain_symbol(F.col("symbol"))).alias("equity"), (market_cap(F.col("marketCap")) >= floor).alias("large"))
    chosen = marked.where("equity and large").select("symbol").distinct()
    everything, carried = chosen, 0
    if existing is not None:
        old = existing.select("symbol").distinct()
        carried = old.join(chosen, "symbol", "left_anti").count()
        everything = chosen.union(old).distinct()
    funnel = marked.agg(F.count("*").alias("listings"), F.count_if("equity").alias("after_security_filter"), F.count_if(F.col("equity") & F.col("large")).alias("after_market_cap_filter"))
    total = everything.agg(F.count("*").alias("total")).withColumn("one", F.lit(1))
    funnel = funnel.withColumn("carried_over", F.lit(carried).cast("bigint")).withColumn("one", F.lit(1)).join(total, "one").drop("one")
    return everything.orderBy("symbol"), funnel


def requested_symbols(universe: DataFrame, anchors: Sequence[str] = tuple(PRICE_ANCHORS)) -> DataFrame:
    """The universe and the anchors, each once, in order."""
    extra = universe.sparkSession.createDataFrame([(a,) for a in anchors], "symbol string")
    return universe.select("symbol").union(extra).distinct().orderBy("symbol")


def provider_symbol(symbol: Column) -> Column:
    return F.translate(symbol, ".", "-")
