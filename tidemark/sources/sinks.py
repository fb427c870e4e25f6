"""Writing the archive: conforming to pinned schemas, partition writes, first-seen ingest of events, compaction and rebuild."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..functions.text import is_blank
from ..operators.asof import event_key, first_per_key, new_events
from ..schemas import EVENT_ALIASES, EVENT_KEY, LEGACY_EVENT_COLUMNS, SCHEMAS
from .archive import Archive, exists, hadoop_path

NOT_FINITE = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan")


def finite_or_null(c: Column, is_text: bool) -> Column:
    """NaN and infinities as null, written as numbers or as words."""
    if is_text:
        return F.when(F.lower(F.trim(c)).isin(*NOT_FINITE), F.lit(None)).otherwise(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def conform(df: DataFrame, dataset: str) -> DataFrame:
    """Core columns first, with their types, then further columns in order of name. A value that doesn't cast becomes null and its text stays in <column>__raw."""
    core, kinds = SCHEMAS[dataset], dict(df.dtypes)
    cols, raw = [], []
    for f in core.fields:
        if f.name not in kinds:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        v = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            v = finite_or_null(v, kinds[f.name] == "string") if kinds[f.name] in ("string", "double", "float") else v
        cast = v.try_cast(f.dataType) if kinds[f.name] != "void" else F.lit(None).cast(f.dataType)
        cols.append(cast.alias(f.name))
        if kinds[f.name] == "string" and not isinstance(f.dataType, StringType):
            raw.append(F.when(v.isNotNull() & cast.isNull(), v).alias(f"{f.name}__raw"))
    names = {f.name for f in core.fields}
    extras = [F.col(f"`{c}`") for c in sorted(df.columns) if c not in names and c != "date"]
    return df.select(*cols, *extras, *raw, *([F.col("date")] if "date" in df.columns else []))


def drop_empty_raw(df: DataFrame) -> DataFrame:
    """Without the __raw columns that no row needs; one aggregation decides."""
    raw = [c for c in df.columns if c.endswith("__raw")]
    if not raw:
        return df
    used = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in raw]).first()
    return df.drop(*[c for c in raw if not used[c]])


def _moved(fs, source, target) -> bool:
    """Whether a rename worked; file systems say no in two ways."""
    try:
        return bool(fs.rename(source, target))
    except Py4JJavaError:
        return False


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Puts a finished folder in the place of another: the old one goes aside, the new one in, then the old one away.

    Whenever a step fails, the old folder stands again; after a crash between the two renames `recover` (which every later write calls) brings it back.
    """
    fs, at = hadoop_path(spark, target)
    aside, new = hadoop_path(spark, _aside(target))[1], hadoop_path(spark, staged)[1]
    fs.mkdirs(at.getParent())
    recover(spark, target)
    if fs.exists(at):
        fs.mkdirs(aside.getParent())
        if not _moved(fs, at, aside):
            raise OSError(f"could not move {target} aside")
    if not _moved(fs, new, at):
        recover(spark, target)
        raise OSError(f"could not move {staged} to {target}")
    fs.delete(aside, True)


def _aside(target: str) -> str:
    head, _, name = target.rpartition("/")
    return f"{head}/_replaced-{name.replace('=', '-')}"


def recover(spark: SparkSession, target: str) -> None:
    """Finishes what a crash of swap_in left: the old folder comes back where no new one stands, else it goes."""
    fs, at = hadoop_path(spark, target)
    aside = hadoop_path(spark, _aside(target))[1]
    if fs.exists(aside):
        if fs.exists(at):
            fs.delete(aside, True)
        elif not _moved(fs, aside, at):
            raise OSError(f"could not bring {target} back")


def _ready(df: DataFrame, dataset: str) -> DataFrame:
    out = drop_empty_raw(conform(df.drop("date"), dataset))
    keys = [c for c in ("canonical_symbol", "symbol", "bar_session") if c in out.columns]
    return out.sortWithinPartitions(*keys) if keys else out


def write_partition(df: DataFrame, root: str, dataset: str, day: str, mode: str = "overwrite") -> None:
    """One partition, written aside first and swapped in, so that the old files stay if the write fails; mode 'append' adds files."""
    target = f"{root}/{dataset}/date={day}"
    writer = _ready(df, dataset).write.option("compression", "zstd")
    if mode == "append":
        recover(df.sparkSession, target)
        writer.mode("append").parquet(target)
        return
    staged = f"{root}/_staging/{dataset}-{day}"
    writer.mode("overwrite").parquet(staged)
    swap_in(df.sparkSession, staged, target)


def replace_batch(df: DataFrame, root: str, dataset: str, day: str, name: str) -> None:
    """Adds a batch to a partition as files called after it; the same batch written again replaces them and leaves all others."""
    spark, target, staged = df.sparkSession, f"{root}/{dataset}/date={day}", f"{root}/_staging/{dataset}-{day}-{name}"
    _ready(df, dataset).write.option("compression", "zstd").mode("overwrite").parquet(staged)
    recover(spark, target)
    fs, at = hadoop_path(spark, target)
    fs.mkdirs(at)
    files = [f.getPath() for f in fs.listStatus(hadoop_path(spark, staged)[1]) if f.getPath().getName().endswith(".parquet")]
    before = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith(f"{name}.")]
    for f in before:
        fs.delete(f, False)
    for i, f in enumerate(files):
        if not _moved(fs, f, hadoop_path(spark, f"{target}/{name}.{i:05d}.parquet")[1]):
            raise OSError(f"could not move {f.toString()} to {target}")
    fs.delete(hadoop_path(spark, staged)[1], True)


def append_rows(df: DataFrame, root: str, dataset: str, day: str) -> None:
    """Adds rows to a partition without reading what it holds."""
    write_partition(df, root, dataset, day, mode="append")


def stamp(df: DataFrame, **values: str) -> DataFrame:
    """Constant columns where they are absent; a column that is there stays, nulls included."""
    for name, v in values.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(v))
    return df


def no_coverage(symbols: DataFrame, dataset: str, snapshot_utc: str, run_id: str) -> DataFrame:
    """Marker rows: asked, and the vendor has nothing."""
    return symbols.select("symbol", F.lit(snapshot_utc).alias("snapshot_utc"), F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"), F.lit(True).alias("no_analyst_coverage"))


def date_part(c: Column) -> Column:
    """The valid ISO date at the head of a time text (yyyy-MM-dd or yyyyMMdd), or null."""
    head = F.substring_index(F.substring_index(c, "T", 1), " ", 1)
    day = F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(head, F.lit("yyyy-MM-dd"))).when(head.rlike(r"^\d{8}$"), F.try_to_timestamp(head, F.lit("yyyyMMdd")))
    return F.date_format(day, "yyyy-MM-dd")


def canonical_events(df: DataFrame) -> DataFrame:
    """Event columns from whichever spelling holds a value, event_date from event_utc, older spellings dropped."""
    for name, spellings in EVENT_ALIASES.items():
        parts = [F.when(~is_blank(F.col(f"`{s}`").cast("string")), F.col(f"`{s}`").cast("string")) for s in spellings if s in df.columns]
        df = df.withColumn(name, F.coalesce(*parts) if parts else F.lit(None).cast("string"))
    return df.withColumn("event_date", date_part(F.col("event_utc"))).drop(*[c for c in LEGACY_EVENT_COLUMNS if c in df.columns and c not in EVENT_ALIASES])


def event_rows(df: DataFrame) -> DataFrame:
    """Rows that are events: no marker, with a time."""
    marker = F.coalesce(F.col("no_analyst_coverage"), F.lit(False)) if "no_analyst_coverage" in df.columns else F.lit(False)
    return df.where(~marker & ~is_blank(F.col("event_utc")))


def ingest_events(spark: SparkSession, root: str, events: DataFrame, day: str) -> int:
    """New events go to the first-seen partition of the day and to the index; how many there were. What is known is probed by an anti-join, never rewritten.

    The partition comes first, under a name made of the events themselves: after a crash between the two the same events are new again and replace their own files.
    """
    from ..session import materialize

    archive = Archive(spark, root)
    rows = event_rows(canonical_events(events))
    if "first_seen_utc" not in rows.columns:
        rows = rows.withColumn("first_seen_utc", F.col("snapshot_utc"))
    fresh = materialize(conform(new_events(rows, archive.index()).drop("snapshot_utc"), "rating_events").select(*SCHEMAS["rating_events"].fieldNames()))
    n, mark = fresh.agg(F.count("*"), F.bit_xor(F.xxhash64(*event_key()))).first()
    if n:
        replace_batch(fresh, root, "rating_events", day, f"events-{mark & (2**64 - 1):016x}")
        fresh.write.mode("append").option("compression", "zstd").parquet(f"{root}/_index/rating_events")
    return n


def _replace_index(spark: SparkSession, root: str, df: DataFrame) -> None:
    staged = f"{root}/_staging/rating_events-index"
    df.select(*SCHEMAS["rating_events"].fieldNames()).write.mode("overwrite").option("compression", "zstd").parquet(staged)
    swap_in(spark, staged, f"{root}/_index/rating_events")


def compact_events(spark: SparkSession, root: str) -> int:
    """The index with each event once, at its first sight; how many rows went. Refused where event times are all missing, for then the key says nothing."""
    index = Archive(spark, root).index()
    before, timed = index.agg(F.count("*"), F.count(F.when(~is_blank(F.col("event_utc")), 1))).first()
    if before and not timed:
        raise ValueError("the index has no event times; rebuild it instead")
    names = [f"__{c}" for c in EVENT_KEY]
    kept = first_per_key(index.select("*", *event_key()), names, ["first_seen_utc"]).drop(*names)
    _replace_index(spark, root, kept)
    return before - Archive(spark, root).index().count()


def rebuild_events(spark: SparkSession, root: str) -> dict[str, int]:
    """The index anew from all partitions: for each event the earliest partition, then the earliest row. Counts of partitions and events."""
    archive = Archive(spark, root)
    parts = []
    for name in ("upgrades_downgrades", "rating_events"):
        df = archive.load(name, drop_no_coverage=False)
        seen = F.col("first_seen_utc") if name == "rating_events" else F.col("snapshot_utc")
        rows = event_rows(df).withColumn("first_seen_utc", seen).withColumn("__order", F.concat_ws("|", "trading_date", "first_seen_utc"))
        keep = [f for f in SCHEMAS["rating_events"].fieldNames() if f in rows.columns]
        parts.append(rows.select(*keep, "__order"))
    names = [f"__{c}" for c in EVENT_KEY]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).select("*", *event_key())
    before = archive.index().count()
    _replace_index(spark, root, first_per_key(both, names, ["__order"]).drop(*names, "__order"))
    after = Archive(spark, root).index().count()
    scanned = len(archive.dates("upgrades_downgrades")) + len(archive.dates("rating_events"))
    return {"partitions": scanned, "events_before": before, "events_after": after, "recovered": max(0, after - before)}


def complete_symbols(archive: Archive, datasets: Sequence[str], day: str) -> DataFrame:
    """Symbols that a day's partitions of all datasets hold: a resumed run skips them."""
    out = None
    for d in datasets:
        s = archive.symbols(d, day).select("symbol", F.lit(d).alias("dataset"))
        out = s if out is None else out.unionByName(s)
    return out.groupBy("symbol").agg(F.count_distinct("dataset").alias("n")).where(F.col("n") == len(set(datasets))).select("symbol")


def missing_pairs(archive: Archive, symbols: DataFrame, datasets: Sequence[str], day: str) -> DataFrame:
    """(symbol, dataset) still to be fetched: each symbol with every dataset, less what is there."""
    want = symbols.select("symbol", F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset"))
    have = None
    for d in datasets:
        s = archive.symbols(d, day).select("symbol", F.lit(d).alias("dataset"))
        have = s if have is None else have.unionByName(s)
    return want.join(have, ["symbol", "dataset"], "left_anti")


class SnapshotWriter:
    """Collects the rows of many symbols and writes every `every` symbols, one append per dataset, rating events to their index.

    A dataset that fails doesn't keep the others from being written; the first error is raised at the end.
    """

    def __init__(self, spark: SparkSession, root: str, day: str, run_id: str, every: int = 50):
        self.spark, self.root, self.day, self.run_id, self.every = spark, root, day, run_id, every
        self.rows: dict[str, list[dict]] = {}
        self.events: list[dict] = []
        self.done = self.events_added = 0

    def known_symbols(self, dataset: str) -> DataFrame:
        """Symbols that the day's partition holds, markers included."""
        return Archive(self.spark, self.root).symbols(dataset, self.day)

    def add(self, dataset: str, rows: list[dict]) -> int:
        self.rows.setdefault(dataset, []).extend({"dataset": dataset, "run_id": self.run_id} | r for r in rows)
        return len(rows)

    def add_rating_events(self, rows: list[dict], first_seen_utc: str) -> None:
        """Rows that are events; which of them are new is found when they are written."""
        self.events.extend({"run_id": self.run_id, "dataset": "rating_events", "first_seen_utc": first_seen_utc} | r for r in rows if not r.get("no_analyst_coverage"))

    def symbol_done(self) -> None:
        self.done += 1
        if self.done % self.every == 0:
            self.flush()

    def _frame(self, rows: list[dict]) -> DataFrame:
        names = sorted({k for r in rows for k in r})
        return self.spark.createDataFrame([tuple(None if r.get(k) is None else str(r[k]) for k in names) for r in rows], ", ".join(f"`{n}` string" for n in names))

    def flush(self) -> None:
        error = None
        for dataset in list(self.rows):
            try:
                append_rows(self._frame(self.rows[dataset]), self.root, dataset, self.day)
                del self.rows[dataset]
            except Exception as e:  # noqa: BLE001
                error = error or e
        try:
            if self.events:
                self.events_added += ingest_events(self.spark, self.root, self._frame(self.events), self.day)
                self.events = []
        except Exception as e:  # noqa: BLE001
            error = error or e
        if error:
            raise error


def has_index(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root}/_index/rating_events")
