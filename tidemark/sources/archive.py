"""The archive as DataFrames: vintage-aware scans, as-of filters, latest values, listings.

Layout: <root>/<dataset>/date=YYYY-MM-DD/*.parquet, and <root>/_index/rating_events for the event index.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.text import is_blank, utc_time
from ..schemas import DATASET_CODES, EVENT_ALIASES, LEGACY_EVENT_COLUMNS, MARKET_DATASETS, SCHEMAS, SPELLINGS, known_at
from ..session import materialize

EVENT_DATASETS = ("upgrades_downgrades", "rating_events")


def hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def as_utc(when: str | datetime | date) -> datetime:
    """Text, date or time to an aware UTC time; no zone means UTC."""
    if isinstance(when, str):
        when = datetime.fromisoformat(when.strip())
    if isinstance(when, date) and not isinstance(when, datetime):
        when = datetime(when.year, when.month, when.day)
    return when.replace(tzinfo=UTC) if when.tzinfo is None else when.astimezone(UTC)


class Archive:
    """Reads one archive. Scans are lazy; only listings of folders happen on the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def dates(self, dataset: str) -> list[str]:
        """Partitions that hold Parquet files, in order. From the folder listing: no file is opened."""
        fs, p = hadoop_path(self.spark, f"{self.root}/{dataset}")
        if not fs.exists(p):
            return []
        found = []
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            if name.startswith("date=") and any(f.getPath().getName().endswith(".parquet") and not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(s.getPath())):
                found.append(name.removeprefix("date="))
        return sorted(found)

    def all_dates(self, datasets: Sequence[str] = tuple(DATASET_CODES.values())) -> list[str]:
        """Partitions of any of the datasets."""
        return sorted({d for name in datasets for d in self.dates(name)})

    def previous_date(self, target: str) -> str | None:
        """The latest partition before target."""
        return max((d for d in self.all_dates() if d < target), default=None)

    def _files(self, dataset: str, dates: list[str]) -> DataFrame | None:
        """Partitions grouped by the schema of their files: each group is read with its own types, then brought to the core types by name."""
        groups: dict[str, tuple[StructType, list[str]]] = {}
        jvm_case = self.spark.conf.get("spark.sql.caseSensitive", "false")
        self.spark.conf.set("spark.sql.caseSensitive", "true")
        try:
            merged = self._merged(dataset, dates)
            for d in dates:
                schema = merged or self.spark.read.option("mergeSchema", "true").parquet(f"{self.root}/{dataset}/date={d}").schema
                groups.setdefault(schema.json(), (schema, []))[1].append(d)
            out = None
            for schema, days in groups.values():
                raw = self.spark.read.schema(schema).option("basePath", f"{self.root}/{dataset}").parquet(*[f"{self.root}/{dataset}/date={d}" for d in days])
                named = self._to_core(dataset, raw, schema)
                if len({n.lower() for n in schema.fieldNames()}) < len(schema.fieldNames()):
                    # Names that differ only in case can be planned in a case-sensitive session alone, so these old partitions are read here and now
                    named = materialize(named)
                out = named if out is None else out.unionByName(named, allowMissingColumns=True)
            return out
        finally:
            self.spark.conf.set("spark.sql.caseSensitive", jvm_case)

    def _merged(self, dataset: str, dates: list[str]) -> StructType | None:
        """One schema for all partitions, from one job over their footers; None where types differ or names differ only in case."""
        try:
            schema = self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.root}/{dataset}/date={d}" for d in dates]).schema
        except Exception as e:  # noqa: BLE001
            if "MERGE" not in str(e):
                raise
            return None
        names = schema.fieldNames()
        return schema if len({n.lower() for n in names}) == len(names) else None

    def _to_core(self, dataset: str, raw: DataFrame, schema: StructType) -> DataFrame:
        """Core columns with core types (a value that doesn't cast is null), every other column once, under its first spelling."""
        core, have = SCHEMAS[dataset], {f.name: f.dataType for f in schema.fields}
        # Positions, not names: names may differ only in case
        flat = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
        at = {n: f"c{i}" for i, n in enumerate(raw.columns)}
        cols, used = [], {"date"}
        for f in core.fields:
            spellings = [f.name, *SPELLINGS.get(f.name, []), *(EVENT_ALIASES.get(f.name, []) if dataset in EVENT_DATASETS else [])]
            parts = []
            for s in dict.fromkeys(spellings):
                if s in have:
                    used.add(s)
                    parts.append(F.col(at[s]).try_cast(f.dataType))
            cols.append((F.coalesce(*parts) if parts else F.lit(None).cast(f.dataType)).alias(f.name))
        taken = {f.name.lower() for f in core.fields}
        for n in sorted(have):
            if n not in used and n.lower() not in taken and n not in LEGACY_EVENT_COLUMNS:
                taken.add(n.lower())
                cols.append(F.col(at[n]).cast("double" if isinstance(have[n], DoubleType) else "string" if isinstance(have[n], StringType) else have[n]).alias(n))
        out = flat.select(*cols, F.col(at["date"]).cast("string").alias("trading_date"))
        if dataset in EVENT_DATASETS:
            out = out.withColumn("event_date", F.coalesce("event_date", F.substring("event_utc", 1, 10)))
        return out

    def empty(self, dataset: str) -> DataFrame:
        """No rows, all columns of a scan."""
        schema = StructType([*SCHEMAS[dataset].fields, StructField("trading_date", StringType())])
        return self.spark.createDataFrame([], schema).withColumn("snapshot_ts", F.lit(None).cast("timestamp"))

    def load(self, dataset: str, start: str | None = None, end: str | None = None, symbols: Sequence[str] | None = None, columns: Sequence[str] | None = None, as_of: str | datetime | None = None, drop_no_coverage: bool = True) -> DataFrame:
        """Snapshot rows: partitions in [start, end], symbols of the list, known by as_of; unknown columns are ignored, keys always come along.

        Partitions are pruned before anything is opened; the symbol list and the columns reach the Parquet scan.
        """
        days = [d for d in self.dates(dataset) if (start is None or d >= str(start)) and (end is None or d <= str(end))]
        df = self._files(dataset, days) if days else None
        if df is None:
            df = self.empty(dataset).drop("snapshot_ts")
        if symbols is not None:
            df = df.where(F.col("symbol").isin(list(symbols))) if symbols else df.where(F.lit(False))
        df = df.withColumn("snapshot_ts", utc_time(known_at(dataset)))
        if as_of is not None:
            df = df.where(F.col("snapshot_ts") <= F.lit(as_utc(as_of)))
        if drop_no_coverage and "no_analyst_coverage" in df.columns:
            df = df.where(~F.coalesce(F.col("no_analyst_coverage"), F.lit(False)))
        if columns is not None:
            kept = dict.fromkeys(["symbol", known_at(dataset), "trading_date", "no_analyst_coverage", "snapshot_ts", *columns])
            df = df.select(*[F.col(f"`{c}`") for c in df.columns if c in kept])
        return df

    def load_events(self, start: str | None = None, end: str | None = None, symbols: Sequence[str] | None = None, as_of: str | datetime | None = None, use_index: bool = True) -> DataFrame:
        """Rating events first seen by as_of; start and end bound the event's own date. From the index, or from first-seen partitions."""
        df = self.index() if use_index else self.load("rating_events", drop_no_coverage=False).drop("snapshot_ts")
        df = df.withColumn("first_seen_ts", utc_time("first_seen_utc"))
        if symbols is not None:
            df = df.where(F.col("symbol").isin(list(symbols))) if symbols else df.where(F.lit(False))
        if as_of is not None:
            df = df.where(F.col("first_seen_ts") <= F.lit(as_utc(as_of)))
        if start is not None:
            df = df.where(F.col("event_date") >= str(start))
        if end is not None:
            df = df.where(F.col("event_date") <= str(end))
        return df

    def index(self) -> DataFrame:
        """The event index, its older place, or no rows."""
        for place in ("_index/rating_events", "_index/rating_events.parquet", "rating_events/data.parquet"):
            if exists(self.spark, f"{self.root}/{place}"):
                return self.spark.read.schema(SCHEMAS["rating_events"]).parquet(f"{self.root}/{place}")
        return self.spark.createDataFrame([], SCHEMAS["rating_events"])

    def latest_as_of(self, dataset: str, as_of: str | datetime, symbols: Sequence[str] | None = None, columns: Sequence[str] | None = None, lookback_days: int = 10, group_extra: Sequence[str] | None = None) -> DataFrame:
        """The last value per symbol (and group_extra) that was known at as_of, from the partitions of the lookback window. Markers never hide a value."""
        from ..operators.asof import latest_per_key

        at = as_utc(as_of)
        extra = list(group_extra or [])
        wanted = None if columns is None else [*columns, *extra]
        day = at.date()
        df = self.load(dataset, (day - timedelta(days=lookback_days)).isoformat(), day.isoformat(), symbols, wanted, at)
        return latest_per_key(df, ["symbol", *extra], ["snapshot_ts", "trading_date"])

    def symbols(self, dataset: str, day: str) -> DataFrame:
        """Distinct symbols of one partition, markers included."""
        return self.load(dataset, day, day, columns=["symbol"], drop_no_coverage=False).where(~is_blank(F.col("symbol"))).select("symbol").distinct()

    def universe_by_date(self, dataset: str) -> DataFrame:
        """trading_date, symbols: who was in each partition, so that later universes don't leak back."""
        rows = self.load(dataset, columns=["symbol"], drop_no_coverage=False).select("trading_date", "symbol").distinct()
        return rows.groupBy("trading_date").agg(F.sort_array(F.collect_list("symbol")).alias("symbols"), F.count("*").alias("n_symbols"))

    def summary(self) -> DataFrame:
        """dataset, partitions, first_date, last_date, rows of the index for events."""
        rows = []
        for name in [*DATASET_CODES.values(), *MARKET_DATASETS, "rating_events"]:
            d = self.dates(name)
            rows.append((name, len(d), d[0] if d else None, d[-1] if d else None, self.index().count() if name == "rating_events" else None))
        return self.spark.createDataFrame(rows, "dataset string, partitions int, first_date string, last_date string, index_rows long")


def distinct_in_order(df: DataFrame, col: str, position: str) -> DataFrame:
    """Distinct values in the order of their first occurrence."""
    return df.groupBy(col).agg(F.min(position).alias(position)).orderBy(position)


