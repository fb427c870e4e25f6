"""Text, time and blank handling as Catalyst expressions. None of them raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = r"(?i)(z|[+-]\d{2}:?\d{2})$"
PLACEHOLDERS = ("na", "none", "null", "nan", "unknown", "notavailable")


def strip(c: Column | str) -> Column:
    """Without white space at either end (any kind of it, not only blanks)."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"^[\s ]+|[\s ]+$", "")


def is_blank(c: Column) -> Column:
    """Null, empty or only white space; never null itself."""
    return c.isNull() | c.rlike(r"^\s*$")


def norm_symbol(c: Column | str) -> Column:
    """Upper case, no blanks at the ends, class separator '-'. Null stays null. A symbol that is plain already meets one pattern only."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike("^[A-Z0-9]+(-[A-Z0-9]+)?$"), c).otherwise(F.regexp_replace(F.upper(strip(c)), r"[\s./_\-]+", "-"))


def label_key(c: Column | str) -> Column:
    """Letters and digits of a label in lower case; null for null, blank and placeholder."""
    c = F.col(c) if isinstance(c, str) else c
    key = F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))
    return F.when((key != "") & ~key.isin(*PLACEHOLDERS), key)


def utc_time(c: Column | str) -> Column:
    """ISO date or time of any precision to TIMESTAMP. No zone means UTC, no time of day 00:00; unreadable gives null.

    What is written in a usual form (a date; a date and a time to the second; a time with a zone) is cast at once; patterns are for the rest.
    """
    c = F.col(c) if isinstance(c, str) else c
    size, dashed = F.length(c), (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    zoned = c.endswith("Z") | (F.substring(c, -6, 1).isin("+", "-") & (F.substring(c, -3, 1) == ":"))
    whole = F.when(size == 10, F.concat(c, F.lit("T00:00:00Z"))).when(F.substring(c, 11, 1).isin("T", " "), F.when(size == 19, F.concat(c, F.lit("Z"))).when((size > 19) & zoned, c))
    return F.coalesce(F.when(dashed, whole).try_cast("timestamp"), _utc_time(c))


def _utc_time(c: Column) -> Column:
    s = strip(c)
    s = F.regexp_replace(s, r"^(\d{4})[/.](\d{2})[/.](\d{2})", "$1-$2-$3")
    s = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    s = F.when(~s.contains(":"), F.concat(F.substring(s, 1, 10), F.lit("T00:00:00Z"))).when(s.rlike(ZONE), s).otherwise(F.concat(s, F.lit("Z")))
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), s).try_cast("timestamp")


def has_clock(c: Column | str) -> Column:
    """Whether the text of a time names a time of day."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.contains(":"), F.lit(False))


def utc_day(c: Column | str) -> Column:
    """yyyy-MM-dd, yyyyMMdd or yyyy/MM/dd (a time may follow) to DATE; else null."""
    c = F.col(c) if isinstance(c, str) else c
    usual = F.when((F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-"), c.try_cast("date"))
    s = strip(c)
    digits = F.regexp_replace(F.substring(s, 1, 10), r"[-/.]", "")
    return F.coalesce(usual, F.when(s.rlike(r"^\d{4}[-/.]?\d{2}[-/.]?\d{2}($|[T ])"), F.try_to_timestamp(F.substring(digits, 1, 8), F.lit("yyyyMMdd")).cast("date")))


def day_of(ts: Column) -> Column:
    """UTC date of a TIMESTAMP whatever the session's zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int"))


def present(c: Column) -> Column:
    """A double with NaN as null."""
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """A double with NaN and infinities as null."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def data_rows() -> Column:
    """Rows that are not markers; a null flag is no marker."""
    return ~F.coalesce(F.col("no_analyst_coverage"), F.lit(False))
