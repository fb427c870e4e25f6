"""Late and out-of-order events: stream slicing into panes.

Event time is cut into non-overlapping panes at the granularity of window boundaries. A row that arrives changes the one pane
its event time lies in, by the difference between its report's new value and the value that stood before (`revisions`, `pane_changes`).
Windows are composed of panes: a day's change of a pane recomposes and re-emits the windows that cover the pane, and no others
(`emissions`). What was known when a window was published is its version 0, every later day that changed it is a correction. Rows that
come later than the cut-off or can't be read are left out, and `left_out` counts them.

Edge cases: rows without event day, arrival or report id belong to no pane (they are counted as unreadable), a null or NaN value adds nothing and equals
another missing value, exact repeats (same report, arrival and value) count once, ties of arrival go by row id, a report that moves to another pane
leaves its old one, an empty table gives empty results, further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import day_of

#: pane: its first day; pane_end: the first day after it; delta: what the row adds to its pane; late: came at or after publication
REVISION_COLUMNS = ["table_name", "symbol", "pane", "pane_end", "report_id", "row_id", "arrival", "value", "previous", "delta", "first", "late"]
BEFORE_PUBLICATION = "1970-01-01"


def week_pane(day: Column) -> tuple[Column, Column]:
    """Weeks from Monday: first day and first day of the next."""
    start = F.date_trunc("week", day).cast("date")
    return start, F.date_add(start, 7)


def month_pane(day: Column) -> tuple[Column, Column]:
    """Calendar months."""
    start = F.date_trunc("month", day).cast("date")
    return start, F.add_months(start, 1)


def _readable() -> Column:
    return F.col("event_day").isNotNull() & F.col("arrival").isNotNull() & F.col("report_id").isNotNull()


def _in_time(cutoff_days: int) -> Column:
    return F.datediff(day_of(F.col("arrival")), "event_day") <= cutoff_days


def left_out(rows: DataFrame, cutoff_days: int = 21) -> DataFrame:
    """table_name, reason ('too late', 'unreadable'), n_rows: what `revisions` leaves out."""
    reason = F.when(~_readable(), "unreadable").when(~_in_time(cutoff_days), "too late")
    return rows.withColumn("reason", reason).where("reason is not null").groupBy("table_name", "reason").agg(F.count("*").alias("n_rows"))


def revisions(rows: DataFrame, pane, publish_days: int = 4, cutoff_days: int = 21) -> DataFrame:
    """Every counting row as a change to its pane.

    rows: table_name, symbol, report_id, row_id, event_day DATE, arrival TIMESTAMP, value DOUBLE. Copies collapse before the
    shuffle by report, so a report delivered without end costs one row per distinct (arrival, value).
    """
    start, end = pane(F.col("event_day"))
    counting = rows.where(_readable() & _in_time(cutoff_days))
    once = counting.groupBy("table_name", "report_id", "arrival", "value").agg(F.min(F.struct("row_id", "symbol", "event_day")).alias("r"))
    once = once.select("table_name", "report_id", "arrival", F.when(~F.isnan("value"), F.col("value")).alias("value"), "r.*")
    w = Window.partitionBy("table_name", "report_id").orderBy("arrival", "row_id")
    published = F.unix_date(end) + publish_days
    return (
        once.withColumn("pane", start).withColumn("pane_end", end)
        .withColumn("first", F.row_number().over(w) == 1).withColumn("previous", F.lag("value").over(w)).withColumn("before", F.lag(F.struct("pane", "pane_end")).over(w))
        .withColumn("delta", F.coalesce("value", F.lit(0.0)) - F.when(F.col("before.pane") == F.col("pane"), F.coalesce("previous", F.lit(0.0))).otherwise(0.0))
        .withColumn("late", F.unix_micros("arrival") >= published.cast("long") * 86_400_000_000)
        .select(*REVISION_COLUMNS, F.when(F.col("before.pane") != F.col("pane"), F.col("before")).alias("moved_from"))
    )


def pane_changes(revs: DataFrame) -> DataFrame:
    """table_name, symbol, pane, pane_end, report_id, day, delta, changed, late: each revision as the change of one pane on the day it arrived, and of the pane that its report left, if it did.

    changed: the report's value differs from what stood before; a row that repeats it touches its pane and adds nothing.
    """
    day = day_of(F.col("arrival")).alias("day")
    changed = F.col("first") | ~F.col("value").eqNullSafe(F.col("previous"))
    own = revs.select("table_name", "symbol", "pane", "pane_end", "report_id", day, "delta", changed.alias("changed"), "late")
    gone = revs.where(F.col("moved_from").isNotNull()).select("table_name", "symbol", "moved_from.pane", "moved_from.pane_end", "report_id", day, (-F.coalesce("previous", F.lit(0.0))).alias("delta"), F.lit(False).alias("changed"), F.lit(False).alias("late"))
    return own.unionByName(gone)


def late_cases(changes: DataFrame) -> DataFrame:
    """The reports whose late change corrected their pane."""
    return changes.where("late and changed").select("table_name", "symbol", F.date_format("pane", "yyyy-MM-dd").alias("period_start"), "report_id").distinct()


def emissions(changes: DataFrame, panes_per_window: int = 1, pane_days: int = 7, publish_days: int = 4) -> DataFrame:
    """table_name, symbol, window_start, as_of, total, version, changes, correction: every result that goes out for a window.

    A window starts at a pane and covers panes_per_window of them (panes of pane_days each, where it is more than one). Changes are summed
    by pane and day before they meet windows, so a pane sends at most as many rows as the cut-off allows days, however hot its symbol.
    """
    daily = changes.groupBy("table_name", "symbol", "pane", "pane_end", "day").agg(F.sum("delta").alias("delta"), F.count("*").alias("changes"))
    if panes_per_window > 1:
        start = F.explode(F.transform(F.sequence(F.lit(0), F.lit(panes_per_window - 1)), lambda k: F.date_sub(F.col("pane"), (k * pane_days).cast("int"))))
        covering = daily.select("table_name", "symbol", start.alias("window_start"), "day", "delta", "changes")
        end = F.date_add("window_start", panes_per_window * pane_days)
    else:
        covering, end = daily.withColumnRenamed("pane", "window_start"), F.col("pane_end")
    as_of = F.when(F.col("day") >= F.date_add(end, publish_days), F.col("day")).otherwise(F.lit(BEFORE_PUBLICATION).cast("date"))
    by_day = covering.groupBy("table_name", "symbol", "window_start", as_of.alias("as_of")).agg(F.sum("delta").alias("delta"), F.sum("changes").alias("changes"))
    w = Window.partitionBy("table_name", "symbol", "window_start").orderBy("as_of")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by_day.select("table_name", "symbol", "window_start", "as_of", F.sum("delta").over(running).alias("total"), (F.row_number().over(w) - 1).alias("version"), "changes", (F.col("as_of") > BEFORE_PUBLICATION).alias("correction"))
