"""History of changing entity attributes: gaps and islands over all snapshots.

One row per entity and load is kept, missing attributes take the last known value, and the hash of the attributes is compared with
that of the load before (lag). Every mark starts an island; a running sum numbers the islands, and an island's first
load and the first load of the next give the validity.

Edge cases: null, NaN, blank and placeholder attributes are missing; labels are compared without case, blanks and punctuation, numbers with a
relative tolerance; several rows of an entity and load: the latest snapshot time, then the smallest row id; rows without entity
or load are left out; an empty table gives no versions; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import finite, label_key, strip

OPEN_END = "9999-12-31"


def versions(rows: DataFrame, labels: list[str], numbers: list[str], entity: str = "symbol", load: str = "trading_date", at: str = "at", row_id: str = "row_id", tolerance: float = 1e-6) -> DataFrame:
    """entity, the labels and numbers as first written in the version, version, valid_from, valid_to.

    After the pre-aggregation an entity has one row per load, so a window group never grows beyond the number of loads.
    """
    cols = [*labels, *numbers]
    slim = rows.where(F.col(entity).isNotNull() & F.col(load).isNotNull()).select(
        F.col(entity).alias("e"), F.col(load).alias("d"), F.struct(F.col(at).alias("at"), (-F.col(row_id)).alias("rid"), *[F.when(label_key(c).isNotNull(), strip(c)).alias(c) for c in labels], *[finite(F.col(c)).alias(c) for c in numbers]).alias("v")
    )
    one = slim.groupBy("e", "d").agg(F.max_by("v", F.struct("v.at", "v.rid")).alias("v")).select("e", "d", "v.*")
    by_load = Window.partitionBy("e").orderBy("d")
    known = one.select("e", "d", *[F.last(c, ignorenulls=True).over(by_load.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(c) for c in cols])
    # Hash of what must be equal exactly; numbers enter it only as known or not, for they are compared with the tolerance
    mark = F.xxhash64(*[F.coalesce(label_key(c), F.lit("")) for c in labels], *[F.col(c).isNotNull() for c in numbers])
    hashed = known.withColumn("h", mark)
    prev = hashed.select("*", F.lag("h").over(by_load).alias("h0"), *[F.lag(c).over(by_load).alias(f"{c}__0") for c in numbers])
    moved = F.lit(False)
    for c in numbers:
        a, b = F.col(c), F.col(f"{c}__0")
        moved = moved | F.coalesce(F.abs(a - b) > tolerance * F.greatest(F.abs(a), F.abs(b)), F.lit(False))
    starts = prev.withColumn("start", F.when(F.col("h0").isNull() | (F.col("h") != F.col("h0")) | moved, 1).otherwise(0))
    islands = starts.withColumn("version", F.sum("start").over(by_load.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = islands.groupBy("e", "version").agg(F.min("d").alias("valid_from"), *[F.min_by(c, "d").alias(c) for c in cols])
    until = F.coalesce(F.lead("valid_from").over(Window.partitionBy("e").orderBy("version")), F.lit(OPEN_END))
    return first.select(F.col("e").alias(entity), *cols, "version", "valid_from", until.alias("valid_to"))
