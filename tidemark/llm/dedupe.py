"""Deduplicating new batches against all history: partitioned Bloom filters before a persistent fingerprint store.

Every row has a content: what must be alike for it to repeat an earlier row, as a text (`akey`) within a block (the UTC day of its time).
A batch is prepared (`prepare`: exact copies within it collapse to their first row, before and behind the shuffle; days that rows near
midnight hold together are joined), and then taken up in one job with one shuffle (`take_up`):

1. buckets of days come to tasks, texts within them in order of arrival; a large batch's texts are salted, so that no day has one task only;
2. the contents' winnowed fingerprints are looked up in the store (see `fingerprints`): Bloom filter, postings, shared coverage of at least
   `least`. Covering contents with the same text and day hand over their first rows, others are reported as near-duplicates;
3. in order of arrival each row becomes either a repeat of the first stored or earlier row that it agrees with, or a first row itself;
4. contents with new first rows go to the store, with their fingerprints and filter.

No step reads earlier batches; the store is read where filters pass. Agreement: FromGrade equal or missing in one; times within `minutes`,
or the same UTC day where one has no time of day. Only first rows are compared with, so that chains of near times don't run together.
A task keeps first rows in memory, not rows: of one text, day and FromGrade at most one for every few minutes.

Edge cases: rows without content, time or id are no cases; a null FromGrade agrees with any; ties of arrival don't occur (row ids are unique);
an empty batch adds nothing; contents of any length are read whole; an empty text is a content; rows of batches that aren't listed are no cases; further columns are ignored.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize, remove_path, scratch_path
from .fingerprints import BUCKETS, CONTENTS, ENTRY, FAN, FILE_POSTINGS, Lookup, Store, fingerprints, write_run

DAY = 86_400_000_000
#: A day's texts are spread over one more task for every so many rows of the batch.
SALT_ROWS = 250_000
SAME = ["akey", "day", "t", "clock", "fg"]
SETTLED = "rid long, v1 long, v2 long, rep long, near long, coverage double"


def keyed(rows: DataFrame) -> DataFrame:
    """Rows that can be cases, with v1 and v2: equal for exact copies. day is a date."""
    marked = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in SAME]
    out = rows.where("akey is not null and day is not null and t is not null and row_id is not null")
    return out.withColumn("clock", F.coalesce("clock", F.lit(False))).withColumn("day", F.unix_date("day").cast("long")).withColumn("v1", F.xxhash64(*marked)).withColumn("v2", F.xxhash64(F.lit(1), *marked))


def prepare(rows: DataFrame, minutes: int) -> DataFrame:
    """Keyed rows (batch, row_id, akey, day, t, clock, fg, v1, v2) of any number of batches -> what take_up takes: one row per exact copy of a
    batch, rid its first, and chunk: the number of its day, or of the first of a run of days that rows of the batch near midnight hold together."""
    items = rows.groupBy("batch", "v1", "v2", *SAME).agg(F.min("row_id").alias("rid"))
    edge = minutes * 60_000_000
    into = F.pmod(F.col("t"), F.lit(DAY))
    near = items.where(F.col("clock") & ((into < edge) | (into >= DAY - edge))).select("batch", "akey", F.when(into < edge, F.col("day")).otherwise(F.col("day") + 1).alias("day"), (into < edge).alias("after"))
    bridged = near.groupBy("batch", "akey", "day").agg(F.bool_or("after").alias("a"), F.bool_or(~F.col("after")).alias("b")).where("a and b")
    # A bridge before a day takes that day to the one before; runs of bridges are gaps and islands
    nth = F.row_number().over(Window.partitionBy("batch", "akey").orderBy("day"))
    runs = bridged.withColumn("run", F.col("day") - nth)
    runs = runs.select("batch", "akey", "day", (F.min("day").over(Window.partitionBy("batch", "akey", "run")) - 1).alias("chunk"))
    return items.join(runs, ["batch", "akey", "day"], "left").withColumn("chunk", F.coalesce("chunk", "day"))


class _Group:
    """First rows of one text and run of days; times are kept sorted, so that a row meets only those within reach."""

    def __init__(self, micros: int):
        self.micros, self.timed, self.loose, self.days, self.seen = micros, [], {}, {}, set()

    def add(self, rid: int, t: int, clock: bool, day: int, fg: str | None) -> None:
        if clock:
            bisect.insort(self.timed, (t, rid, fg or ""))
        else:
            self.loose.setdefault(day, []).append((rid, fg or ""))
        self.days.setdefault(day, []).append((rid, fg or ""))

    def first(self, rid: int, t: int, clock: bool, day: int, fg: str | None) -> int:
        """The first row this one agrees with, or itself."""
        if clock:
            lo = bisect.bisect_left(self.timed, (t - self.micros, -1, ""))
            hi = bisect.bisect_right(self.timed, (t + self.micros, 1 << 63, ""))
            near = [x[1:] for x in self.timed[lo:hi]] + self.loose.get(day, [])
        else:
            near = self.days.get(day, [])
        return min((r for r, g in near if not fg or not g or g == fg), default=rid)


class _Held:
    """New first rows of one bucket by content, as columns."""

    def __init__(self):
        self.at: dict[tuple[str, int], int] = {}
        self.fps: list[np.ndarray] = []
        self.entries: list[list[tuple]] = []

    def table(self) -> pa.Table:
        sizes, flat = [len(f) for f in self.fps], [e for some in self.entries for e in some]
        offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        columns = [pa.array(x, t.type) for x, t in zip(zip(*flat, strict=True), ENTRY.value_type.fields, strict=True)]
        entries = pa.ListArray.from_arrays(offsets([len(e) for e in self.entries]), pa.StructArray.from_arrays(columns, fields=ENTRY.value_type.fields))
        fps = pa.ListArray.from_arrays(offsets(sizes), pa.array(np.concatenate(self.fps), pa.int64()))
        return pa.table([pa.array([k for k, _ in self.at], pa.string()), pa.array([d for _, d in self.at], pa.int64()), fps, entries], schema=CONTENTS)


class _Writer:
    """Contents with new first rows, written by bucket when enough have come together and at the end."""

    def __init__(self, store: Store, run: str):
        self.store, self.run, self.rows, self.postings, self.part = store, run, {}, 0, 0

    def add(self, bucket: int, content: tuple[str, int], fps: np.ndarray, entry: tuple) -> None:
        held = self.rows.setdefault(bucket, _Held())
        n = held.at.setdefault(content, len(held.at))
        if n == len(held.fps):
            held.fps.append(fps)
            held.entries.append([])
            self.postings += len(fps)
        held.entries[n].append(entry)

    def flush(self) -> None:
        task = TaskContext.get().partitionId()
        for bucket, held in self.rows.items():
            write_run(self.store.folder, f"{self.run}/{bucket}/{task}-{self.part}", held.table())
        self.rows, self.postings, self.part = {}, 0, self.part + 1


def _settler(uri: str, run: str, minutes: int, least: float):
    """Rows sorted by chunk, akey and rid -> SETTLED; new contents go to the store's folder `run`."""
    micros = minutes * 60_000_000

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(uri)
        lookup, writer = Lookup(store), _Writer(store, run)
        last, group = None, _Group(micros)
        for batch in batches:
            akey, chunk, day, t, clock, fg, rid = (batch.column(c).to_pylist() for c in ("akey", "chunk", "day", "t", "clock", "fg", "rid"))
            asked: dict[tuple[str, int], int] = {}
            wanted = []
            for k, d, x, timed in zip(akey, day, t, clock, strict=True):
                into = x % DAY
                days = (d, d - 1) if timed and into < micros else (d, d + 1) if timed and into >= DAY - micros else (d,)
                wanted.append(days)
                for one in days:
                    asked.setdefault((k, one), len(asked))
            texts, blocks = [k for k, _ in asked], np.array([d for _, d in asked], dtype=np.int64)
            fps, sizes = fingerprints(texts, blocks)
            starts, buckets = (np.cumsum(sizes) - sizes).tolist(), store.bucket(blocks).tolist()
            known: dict[tuple[str, int], list[dict]] = {}
            near: dict[tuple[str, int], tuple[float, int]] = {}
            names = list(asked)
            for a, share, row in lookup.covering(blocks, fps, sizes, least):
                if (row["akey"], row["block"]) == names[a]:
                    known.setdefault(names[a], []).extend(row["entries"])
                else:
                    first = min(e["rid"] for e in row["entries"])
                    near[names[a]] = min(near.get(names[a], (0.0, first)), (-share, first))
            rep, beside, shares = [], [], []
            for i, k in enumerate(akey):
                if (k, chunk[i]) != last:
                    last, group = (k, chunk[i]), _Group(micros)
                for d in wanted[i]:
                    if d not in group.seen:
                        group.seen.add(d)
                        for e in known.get((k, d), ()):
                            group.add(e["rid"], e["t"], e["clock"], d, e["fg"])
                r = group.first(rid[i], t[i], clock[i], day[i], fg[i])
                if r == rid[i]:
                    group.add(r, t[i], clock[i], day[i], fg[i])
                    a = asked[k, day[i]]
                    writer.add(buckets[a], names[a], fps[starts[a] : starts[a] + sizes[a]], (r, t[i], clock[i], fg[i]))
                rep.append(r)
                share, first = near.get((k, day[i]), (None, None))
                beside.append(first)
                shares.append(None if share is None else -share)
            if writer.postings > FILE_POSTINGS:
                writer.flush()
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("v1"), batch.column("v2"), pa.array(rep, pa.int64()), pa.array(beside, pa.int64()), pa.array(shares, pa.float64())],
                names=["rid", "v1", "v2", "rep", "near", "coverage"],
            )
        writer.flush()

    return run_batches


def _merge(spark: SparkSession, store: Store, runs: list[str]) -> tuple[list[str], list[str]]:
    """Merges the last FAN runs of a level as long as there are as many: the runs that stand now, and those they replace, whose files may go once the manifest no longer names them."""
    gone: list[str] = []
    while len(runs) >= FAN and len({r.split("-")[0] for r in runs[-FAN:]}) == 1:
        old, level = runs[-FAN:], int(runs[-1].split("-")[0]) + 1
        into, uri = f"{level}-{uuid.uuid4().hex}", store.uri

        def run(batches: Iterator[pa.RecordBatch], old=old, into=into) -> Iterator[pa.RecordBatch]:
            there = Store(uri)
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([there.merge(old, into, k) for k in b.column(0).to_pylist()], pa.int64())], names=["files"])

        spark.range(0, store.buckets, 1, min(store.buckets, spark.sparkContext.defaultParallelism * 2)).mapInArrow(run, "files long").agg(F.sum("files")).collect()
        runs, gone = [*runs[:-FAN], into], [*gone, *old]
    return runs, gone


def take_up(store: Store, items: DataFrame, rows: int, out: str, minutes: int = 10, least: float = 0.8) -> None:
    """Settle a batch of so many prepared rows against the store, which then knows it; SETTLED rows go to the folder `out`."""
    spark, run = items.sparkSession, f"0-{uuid.uuid4().hex}"
    spread = items.withColumn("bucket", F.pmod("chunk", F.lit(store.buckets))).withColumn("salt", F.pmod(F.xxhash64("akey"), F.lit(1 + rows // SALT_ROWS)))
    spread = spread.repartition("bucket", "salt").sortWithinPartitions("bucket", "chunk", "akey", "rid")
    settled = spread.select("akey", "chunk", "day", "t", "clock", "fg", "rid", "v1", "v2").mapInArrow(_settler(store.uri, run, minutes, least), SETTLED)
    settled.write.mode("overwrite").parquet(out)
    runs, gone = _merge(spark, store, [*store.runs, run])
    store.commit(runs, store.batches + 1)
    for old in gone:
        store.folder.remove(old)


def dedupe_batches(rows: DataFrame, batch_col: str, batches: list, minutes: int = 10, least: float = 0.8, store_path: str | None = None, near: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """All batches in turn, each against what the earlier ones left in the store: pairs (row_id_a, row_id_b).

    store_path: a folder of the shared file system where the store stays, for runs to come; without one it goes with the result. With `near` the
    pairs are near-duplicates instead: rows that repeat nothing, whose content shares at least `least` of its fingerprints with an earlier
    batch's content of the same day, and that share (row_id_a is that content's first row).
    """
    spark = rows.sparkSession
    schema = "row_id_a long, row_id_b long" + (", coverage double" if near else "")
    if not batches:
        return spark.createDataFrame([], schema)
    path = scratch_path(spark, "batches")
    numbers = spark.createDataFrame([(k, b) for k, b in enumerate(batches)], f"batch int, batch_name {dict(rows.dtypes)[batch_col]}")
    numbers = F.broadcast(numbers) if len(batches) <= 10_000 else numbers
    kept = keyed(rows).select("row_id", *SAME, "v1", "v2", F.col(batch_col).alias("batch_of"))
    kept.join(numbers, kept["batch_of"].eqNullSafe(numbers["batch_name"])).drop("batch_of", "batch_name").write.parquet(f"{path}/rows")
    all_rows = spark.read.schema("row_id long, akey string, day long, t long, clock boolean, fg string, v1 long, v2 long, batch int").parquet(f"{path}/rows")
    prepare(all_rows, minutes).write.partitionBy("batch").parquet(f"{path}/items")
    items = spark.read.schema("akey string, day long, t long, clock boolean, fg string, v1 long, v2 long, rid long, chunk long, batch int").parquet(f"{path}/items")
    sizes = dict(items.groupBy("batch").count().collect())  # a row per batch
    store = Store(store_path or f"{path}/store", buckets)
    store.commit(store.runs, store.batches)
    for k in sorted(sizes):
        take_up(store, items.where(F.col("batch") == k), sizes[k], f"{path}/settled/batch={k}", minutes, least)
    settled = spark.read.schema(f"{SETTLED}, batch int").parquet(f"{path}/settled") if sizes else spark.createDataFrame([], f"{SETTLED}, batch int")
    if near:
        found = settled.where("rid = rep and near is not null").select(F.col("near").alias("row_id_a"), F.col("rid").alias("row_id_b"), "coverage")
    else:
        pairs = all_rows.select("batch", "v1", "v2", "row_id").join(settled.select("batch", "v1", "v2", "rep"), ["batch", "v1", "v2"]).where("row_id <> rep")
        found = pairs.select(F.col("rep").alias("row_id_a"), F.col("row_id").alias("row_id_b"))
    out = materialize(found)
    remove_path(spark, path)
    return out
