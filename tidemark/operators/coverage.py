"""Coverage and regression reports of a day's partitions, as aggregates that only small counts leave."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DATASET_CODES, METADATA_COLUMNS
from ..sources.archive import Archive
from .normalize import data_bearing

SAMPLE_MISSING, SAMPLE_NO_COVERAGE = 50, 100


def sample(df: DataFrame, col: str, n: int) -> tuple[list[str], int]:
    """The first n distinct values in order, and how many were left out. Spark takes the n before they reach the driver."""
    d = df.select(col).distinct()
    got = [r[0] for r in d.orderBy(col).limit(n).collect()]
    return got, max(d.count() - n, 0)


def newly_uncovered(today: DataFrame, before: DataFrame) -> DataFrame:
    """Symbols marked without coverage today, not marked before, though they were there: (A - B) intersect C."""
    marked = lambda df: df.where(F.coalesce(F.col("no_analyst_coverage"), F.lit(False))).select("symbol").distinct()
    return marked(today).join(marked(before), "symbol", "left_anti").join(before.select("symbol").distinct(), "symbol", "left_semi")


def dataset_coverage(archive: Archive, dataset: str, expected: DataFrame, day: str, previous: str | None) -> dict:
    """The report of one dataset; ratios are rounded in Python."""
    today = archive.load(dataset, day, day, drop_no_coverage=False)
    before = archive.load(dataset, previous, previous, drop_no_coverage=False) if previous else archive.empty(dataset)
    exp = expected.select("symbol").distinct()
    n_exp = exp.count()
    with_data = data_bearing(today.where(~F.coalesce("no_analyst_coverage", F.lit(False))), METADATA_COLUMNS | {"snapshot_ts"}).where("symbol is not null").select("symbol").distinct()
    covered = exp.join(with_data, "symbol", "left_semi").count()
    seen = today.where("symbol is not null").select("symbol").distinct()
    recorded = exp.join(seen, "symbol", "left_semi").count()
    missing, missing_more = sample(exp.join(with_data, "symbol", "left_anti"), "symbol", SAMPLE_MISSING)
    bare, bare_more = sample(today.where(F.coalesce("no_analyst_coverage", F.lit(False))), "symbol", SAMPLE_NO_COVERAGE)
    lost = newly_uncovered(today, before)
    lost_names, lost_more = sample(lost, "symbol", SAMPLE_NO_COVERAGE)
    counts = today.agg(F.count("*"), F.count_distinct("symbol")).first()
    old = before.agg(F.count("*"), F.count_distinct("symbol")).first()
    return {
        "symbol_coverage_ratio": round(covered / n_exp, 4) if n_exp else 0.0, "symbols_with_data": covered, "recorded_symbol_ratio": recorded / n_exp if n_exp else 0.0, "run_date_symbols_snapshotted": counts[1], "run_date_rows": counts[0],
        "compare_date_symbols_snapshotted": old[1], "compare_date_rows": old[0], "missing_symbols": missing, "missing_symbols_truncated": missing_more, "symbols_with_no_analyst_coverage": bare,
        "symbols_with_no_analyst_coverage_truncated": bare_more, "newly_uncovered_symbols": lost_names, "newly_uncovered_symbols_count": len(lost_names) + lost_more, "path": f"{archive.root}/{dataset}/date={day}",
    }


def coverage_report(archive: Archive, expected: DataFrame, run_date: str | None = None, compare_date: str | None = None, datasets: Sequence[str] = tuple(DATASET_CODES.values()), failures: list | None = None) -> dict:
    """All datasets of a day against the day before; by default the newest partition."""
    days = archive.all_dates(datasets)
    day = run_date or (days[-1] if days else None)
    previous = compare_date or max((d for d in days if day and d < day), default=None)
    parts = {d: dataset_coverage(archive, d, expected, day, previous) for d in datasets} if day else {}
    return {
        "expected_symbols": expected.select("symbol").distinct().count(), "run_date": day, "compare_date": previous, "available_dates": len(days), "datasets": parts,
        "min_symbol_coverage_ratio": min((p["symbol_coverage_ratio"] for p in parts.values()), default=0.0), "failures": failures or [],
    }


def passes(report: dict, fail_under: float | None) -> bool:
    """Whether the lowest ratio of all datasets reaches the threshold."""
    return fail_under is None or report["min_symbol_coverage_ratio"] >= fail_under


def run_counters(rows: DataFrame) -> DataFrame:
    """rows_written, no_coverage and symbols by dataset, for the run manifest."""
    return rows.groupBy("dataset").agg(F.count("*").alias("rows_written"), F.count_if(F.coalesce(F.col("no_analyst_coverage"), F.lit(False))).alias("no_coverage"), F.count_distinct("symbol").alias("symbols"))
