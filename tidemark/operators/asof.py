"""Latest, first-seen and restated values: arg-max and arg-min per key, overlays, comparisons of loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import is_blank
from ..schemas import EVENT_KEY
from ..session import materialize


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest order per key; null keys are equal. A rank of 1 lets Spark cut groups before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *tie]])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The row with the least order per key."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def event_key() -> list[Column]:
    """The event key with blanks as empty text; values themselves are not trimmed."""
    return [F.when(is_blank(F.col(c)), F.lit("")).otherwise(F.col(c)).alias(f"__{c}") for c in EVENT_KEY]


def new_events(events: DataFrame, index: DataFrame) -> DataFrame:
    """Events whose key the index doesn't hold, each once, the earliest seen."""
    keyed = events.select("*", *event_key())
    names = [f"__{c}" for c in EVENT_KEY]
    fresh = keyed.join(index.select(*event_key()).distinct(), names, "left_anti")
    return first_per_key(fresh, names, ["first_seen_utc"]).drop(*names)


def overlay(base: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both; where keys meet, the newer one stands."""
    both = base.withColumn("__p", F.lit(0)).unionByName(newer.withColumn("__p", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, keys, ["__p"]).drop("__p")


def restatements(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two loads has, with side 'removed' or 'added'; copies count."""
    cols = [c for c in old.columns if c in new.columns]
    gone, come = old.select(*cols).exceptAll(new.select(*cols)), new.select(*cols).exceptAll(old.select(*cols))
    return gone.withColumn("side", F.lit("removed")).unionByName(come.withColumn("side", F.lit("added")))


def batch_number(df: DataFrame, order: str, size: int = 50) -> DataFrame:
    """Numbers batches of `size` rows in the order of a column.

    Ranges are numbered apart and offset by the sums of those before, so that no task sorts the whole table.
    """
    ranged = materialize(df.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    nr = F.row_number().over(Window.partitionBy("__part").orderBy(order)) + F.col("__before")
    return ranged.join(F.broadcast(before), "__part").withColumn("batch_no", (F.floor((nr - 1) / size) + 1).cast("bigint")).drop("__part", "__before")


def unsorted_rows(df: DataFrame, keys: Sequence[str], position: str, shard: str) -> DataFrame:
    """Rows whose key is below that of the row before them in their file (shard)."""
    w = Window.partitionBy(shard).orderBy(position)
    key = F.struct(*keys)
    return df.withColumn("__prev", F.lag(key).over(w)).where(F.col("__prev") > key).drop("__prev")


def duplicate_pairs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows repeat a key: one row, duplicates BIGINT."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
