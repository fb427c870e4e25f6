"""Attributes as known at event time: an as-of join sharded by time.

Entities with many rows are cut into shards by time. The best version of all earlier shards is carried into each shard as one row,
so that every shard is merged on its own and no result depends on where the cuts lie.

Which version is best is a total order (`rank`), and only versions known at or before the event take part; a version that became known
later never does. Ties of time count as known. Events without entity or time, or before any version, have no match.
Empty tables give an empty result; further columns are ignored; repeated rows are matched one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize

#: Rows of one entity that a shard should hold, and cells of time counted for each shard before cuts are laid between them.
SHARD_ROWS, CELLS = 256, 64

BLOCK_CELLS = 4096


def shard_map(events: DataFrame, versions: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """hot(entity, lo, width): the entities with more than shard_rows rows and how their time is cut into cells; cells(entity, cell, shard).

    A shard is a run of cells that begin within the same shard_rows rows of the entity, so there are as many as the rows ask for. Rows of one
    instant stay together.
    """
    both = events.select("entity", "t").unionByName(versions.select("entity", "t"))
    hot = both.groupBy("entity").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).where(F.col("n") > shard_rows)
    hot = hot.select("entity", "lo", F.ceil((F.col("hi") - F.col("lo") + 1) / (CELLS * F.ceil(F.col("n") / shard_rows))).alias("width"))
    counts = both.join(hot, "entity").groupBy("entity", _cell()).agg(F.count("*").alias("n"))
    # Rows before each cell: those of earlier blocks of cells, and those of earlier cells of its block, so that no group has all of an entity's cells
    counts = counts.withColumn("block", F.floor(F.col("cell") / BLOCK_CELLS))
    blocks = counts.groupBy("entity", "block").agg(F.sum("n").alias("s"))
    upto = F.coalesce(F.sum("s").over(Window.partitionBy("entity").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("entity", "block").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumn("inside", inside).join(blocks.select("entity", "block", upto.alias("upto")), ["entity", "block"])
    return hot, placed.select("entity", "cell", F.floor((F.col("upto") + F.col("inside")) / shard_rows).alias("shard"))


def _cell():
    return F.floor((F.col("t") - F.col("lo")) / F.col("width")).alias("cell")


def as_known(events: DataFrame, versions: DataFrame, shard_rows: int = SHARD_ROWS, found_only: bool = True) -> DataFrame:
    """events(entity, t long micros, event_id) with the best of versions(entity, t, rank struct) known by then -> event_id, best."""
    events = events.where(F.col("entity").isNotNull() & F.col("t").isNotNull()).select("entity", "t", "event_id")
    versions = versions.where(F.col("entity").isNotNull() & F.col("t").isNotNull()).select("entity", "t", "rank")
    # Both sides are read several times below; once materialised, their times needn't be parsed again
    events, versions = materialize(events), materialize(versions)
    hot, cells = shard_map(events, versions, shard_rows)
    # Best of each (entity, instant) first: copies and restatements collapse before the shuffle
    versions = versions.groupBy("entity", "t").agg(F.max("rank").alias("rank"))

    def sharded(df: DataFrame) -> DataFrame:
        placed = df.join(hot, "entity", "left").withColumn("cell", _cell()).drop("lo", "width")
        return placed.join(cells, ["entity", "cell"], "left").withColumn("shard", F.coalesce("shard", F.lit(0))).drop("cell")

    v = sharded(versions)
    # The best of all earlier shards, for every shard of a hot entity: one row per shard goes through the window
    bests = cells.select("entity", "shard").distinct().join(v.groupBy("entity", "shard").agg(F.max("rank").alias("best")), ["entity", "shard"], "left")
    earlier = Window.partitionBy("entity").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    carried = bests.select("entity", "shard", F.max("best").over(earlier).alias("rank")).where("rank is not null")
    rows = (
        v.select("entity", "shard", "t", "rank", F.lit(None).cast("long").alias("event_id"))
        .unionByName(carried.select("entity", "shard", F.lit(-(2**62)).alias("t"), "rank", F.lit(None).cast("long").alias("event_id")))
        .unionByName(sharded(events).select("entity", "shard", "t", F.lit(None).cast(v.schema["rank"].dataType).alias("rank"), "event_id"))
    )
    # An event without an id is a row with a version's null id but no rank: it is no event
    w = Window.partitionBy("entity", "shard").orderBy("t", F.col("event_id").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = rows.withColumn("best", F.max("rank").over(w)).where("event_id is not null")
    return merged.where("best is not null").select("event_id", "best") if found_only else merged.select("event_id", "best")
