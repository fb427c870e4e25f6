"""Structured Streaming: first-seen ingest of events, micro-batch appends, and panes kept up to date by late rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..operators import panes
from ..schemas import EVENT_KEY
from ..session import materialize
from ..sources.sinks import canonical_events, event_rows, replace_batch


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def first_seen(stream: DataFrame) -> DataFrame:
    """Each event once, when its key first arrives. State holds every key: an event may come again after any time."""
    rows = event_rows(canonical_events(stream))
    keys = {f"__{c}": F.when(is_blank(F.col(c)), F.lit("")).otherwise(F.col(c)) for c in EVENT_KEY}
    return rows.withColumns(keys).dropDuplicates(list(keys)).drop(*keys)


def append_stream(stream: DataFrame, root: str, dataset: str, day: str, checkpoint: str):
    """Appends each micro-batch to a partition under names of its own; a batch that is repeated after a failure replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            replace_batch(batch, root, dataset, day, f"stream-{batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_totals(stream: DataFrame, event_time: str, value: str, window: str = "7 days", late: str = "21 days", keys: tuple[str, ...] = ()) -> DataFrame:
    """Totals by event-time window with a watermark: late rows correct their window until the cut-off, then the window's state goes.

    Rows beyond the watermark are dropped by Spark; the query's progress counts them (numRowsDroppedByWatermark), and `pane_stream` writes them down.
    """
    return stream.withWatermark(event_time, late).groupBy(F.window(event_time, window), *keys).agg(F.sum(value).alias("total"), F.count("*").alias("n"))


REPORTS = "table_name string, symbol string, report_id long, row_id long, event_day date, arrival timestamp, value double"
CHANGES = "table_name string, symbol string, pane_end date, report_id long, day date, delta double, changed boolean, late boolean"


def _kept(spark: SparkSession, store: str, part: str, schema: str, panes_wanted: list[str], before: int) -> DataFrame:
    """What earlier batches left of some panes; other panes' folders aren't opened."""
    from ..sources.archive import exists

    if not exists(spark, f"{store}/{part}"):
        return spark.createDataFrame([], f"{schema}, b int, pane string")
    return spark.read.schema(f"{schema}, b int, pane string").parquet(f"{store}/{part}").where(F.col("pane").isin(panes_wanted) & (F.col("b") < before))


def pane_stream(stream: DataFrame, pane: Callable, store: str, checkpoint: str, cutoff_days: int = 21, panes_per_window: int = 1, pane_days: int = 7):
    """Keeps panes as Parquet by batch and pane: a batch reads the reports of the panes its rows lie in, adds their changes, and emits again the windows that cover a changed pane.

    stream columns: as panes.revisions wants them; a report keeps its pane. Store: reports, changes (<part>/b=<id>/pane=<day>), windows and left_out (<part>/b=<id>);
    a repeated batch overwrites its own folders. Only rows within the cut-off count, so a batch reaches the panes of cutoff_days, besides those of rows that were waiting.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = F.date_format(pane(F.col("event_day"))[0], "yyyy-MM-dd")
        new = materialize(batch.select("table_name", "symbol", "report_id", "row_id", "event_day", "arrival", "value", start.alias("pane")))
        panes.left_out(new, cutoff_days).write.mode("overwrite").parquet(f"{store}/left_out/b={batch_id}")
        touched = [r[0] for r in new.where("pane is not null").select("pane").distinct().collect()]  # a batch's panes
        old = _kept(spark, store, "reports", REPORTS, touched, batch_id).join(new.select("table_name", "report_id").distinct(), ["table_name", "report_id"], "left_semi")
        known = old.select("table_name", "report_id", "row_id").distinct()
        revs = panes.revisions(old.drop("b", "pane").unionByName(new.drop("pane")), pane, cutoff_days=cutoff_days).join(known, ["table_name", "report_id", "row_id"], "left_anti")
        changes = panes.pane_changes(revs).withColumn("pane", F.date_format("pane", "yyyy-MM-dd"))
        changes.write.mode("overwrite").partitionBy("pane").parquet(f"{store}/changes/b={batch_id}")
        new.where("pane is not null").write.mode("overwrite").partitionBy("pane").parquet(f"{store}/reports/b={batch_id}")
        # Windows that cover a touched pane, from all panes these windows cover
        starts = sorted({(date.fromisoformat(p) - timedelta(days=pane_days * k)).isoformat() for p in touched for k in range(panes_per_window)})
        wanted = sorted({(date.fromisoformat(s) + timedelta(days=pane_days * k)).isoformat() for s in starts for k in range(panes_per_window)})
        kept = _kept(spark, store, "changes", CHANGES, wanted, batch_id + 1).withColumn("pane", F.col("pane").cast("date"))
        mine = kept.where(F.col("b") == batch_id).select("table_name", "symbol").distinct()
        out = panes.emissions(kept.join(mine, ["table_name", "symbol"], "left_semi").drop("b"), panes_per_window, pane_days)
        last = out.groupBy("table_name", "symbol", "window_start").agg(F.max_by("total", "version").alias("total"), F.max("version").alias("version"))
        last.where(F.date_format("window_start", "yyyy-MM-dd").isin(starts)).write.mode("overwrite").parquet(f"{store}/windows/b={batch_id}")

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pane_totals(spark: SparkSession, store: str) -> DataFrame:
    """Present totals of all panes from the changes kept."""
    return spark.read.schema(f"{CHANGES}, b int, pane string").parquet(f"{store}/changes").groupBy("table_name", "symbol", F.col("pane").cast("date").alias("pane")).agg(F.sum("delta").alias("total"))
