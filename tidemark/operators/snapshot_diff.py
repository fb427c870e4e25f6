"""What changed between full snapshots: subtracted invertible Bloom lookup tables.

Every load of a table is summarised, per hash bucket of its keys, by an invertible Bloom lookup table (IBLT) over the pairs
(key hash, value hash). The tables of consecutive loads are subtracted, and what is left is peeled into the pairs that only
one of the two loads holds. How large a bucket's table has to be is estimated first, from bits that every pair flips: where nearly
every record changed it is large at once, where few did it is small. A bucket that doesn't peel to zero is built again, larger, until
it does. A digest of what was recovered must equal the digest of what was subtracted. The records under a recovered key hash are then
compared: one found in the later load only was added, in the earlier only removed, in both changed if a value differs by more than the
tolerance. Keys themselves are compared, not only their hashes.

Edge cases: a null part of a key counts as an empty string, null and NaN values are missing, infinities are values, repeated rows
count once, of several rows for a key and load the one with the latest time (then the smallest row id) stands, a table
with fewer than two loads gives no rows, further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.xxh import xxhash64
from ..session import materialize

HASHES = 3
#: Records of a load that one bucket should hold, cells of the smallest lookup table, and by how much a failed one grows.
BUCKET_RECORDS, LEAST_CELLS, GROWTH, MAX_ROUNDS = 1024, 48, 4, 6
#: Bits of a bucket's sketch, and the largest table that is planned from it: where more than that differs, nearly everything does.
SKETCH_BITS, MOST_CELLS = 8192, 12_288
PEELED = "table_name string, bucket long, pair int, size long, kh long, ok boolean"


def latest_records(rows: DataFrame, table_name: str, key: Column, values: list[str], load: str = "trading_date", at: str = "at", row_id: str = "row_id") -> DataFrame:
    """One row per (key, load): table_name, record_key, load, vals array<double> of the row with the latest time."""
    from ..functions.text import present

    slim = rows.select(key.alias("record_key"), F.col(load).alias("load"), F.struct(F.col(at).alias("at"), (-F.col(row_id)).alias("rid"), F.array(*[present(F.col(f"`{v}`").cast("double")) for v in values]).alias("vals")).alias("v"))
    best = slim.where(F.col("load").isNotNull()).groupBy("record_key", "load").agg(F.max_by("v", F.struct("v.at", "v.rid")).alias("v"))
    return best.select(F.lit(table_name).alias("table_name"), "record_key", "load", F.col("v.vals").alias("vals"))


def rounded(v: Column) -> Column:
    """Eight significant digits of a double and its exponent as one double: equal unless values differ by 1e-8 to 1e-7 or straddle a step."""
    size = F.greatest(F.abs(v), F.lit(1e-300))
    e = F.floor(F.log10(F.least(size, F.lit(1.7e308)))).cast("double")
    return F.when(v == 0, F.lit(0.0)).when(F.abs(v) == float("inf"), F.signum(v) * 1e18).otherwise(F.rint(F.signum(v) * (size / F.pow(F.lit(10.0), e)) * 1e7) * 1000 + e)


def hashed(records: DataFrame) -> DataFrame:
    """Adds the key hash, the value hash and the pair's check hash."""
    marked = F.transform("vals", lambda v: F.coalesce(rounded(v), F.lit(7e200)))  # Spark's hash skips nulls, so that a value that moves to another column would go unseen
    out = records.withColumn("kh", F.xxhash64("table_name", "record_key")).withColumn("vh", F.xxhash64(marked))
    return out.withColumn("ck", F.xxhash64("kh", "vh"))


def planned(records: DataFrame, last: DataFrame, least_cells: int = LEAST_CELLS) -> DataFrame:
    """table_name, bucket, pair, size: cells for every bucket and pair of loads.

    Each pair of hashes flips one bit of its load's sketch; the sketches of two loads differ in as many bits as an unknown number of pairs, thrown at random, would set.
    """
    h = F.xxhash64("ck", F.lit(-1).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))
    word = F.pmod(F.shiftrightunsigned(h, 6), F.lit(SKETCH_BITS // 64)).cast("int")
    words = records.groupBy("table_name", "bucket", "idx", word.alias("word")).agg(F.bit_xor(bit).alias("bits"))
    both = words.select("table_name", "bucket", "word", "bits", F.explode(F.array(F.col("idx"), F.col("idx") + 1)).alias("pair"))
    odd = both.groupBy("table_name", "bucket", "pair", "word").agg(F.bit_xor("bits").alias("bits")).groupBy("table_name", "bucket", "pair").agg(F.sum(F.bit_count("bits")).alias("odd"))
    share = F.least(1 - 2 * F.col("odd") / SKETCH_BITS, F.lit(1.0))
    differ = F.when(share > 0, -F.log(share) * SKETCH_BITS / 2)
    # A table of three hashes comes apart up to a load of about 0.8; sizes go by powers of two
    steps = F.ceil(F.log2(F.greatest(F.lit(1.0), (1.45 * differ + 24) / least_cells)))
    size = F.least(F.lit(MOST_CELLS).cast("long"), (F.pow(F.lit(2.0), F.coalesce(steps, F.lit(30))) * least_cells).cast("long"))
    return odd.withColumn("size", size).join(last, "table_name").where("pair > 1 and pair <= last").select("table_name", "bucket", "pair", "size")


def tables(records: DataFrame, plan: DataFrame, salt: int) -> DataFrame:
    """Subtracted cells (table, bucket, pair, size, cell, n, kh, vh, ck) of the pairs in plan: each load's table, built once for every size it is wanted in, minus that of the load before; cells that cancel out are gone."""
    wanted = plan.select("table_name", "bucket", "size", F.explode(F.array(F.col("pair"), F.col("pair") - 1)).alias("idx")).groupBy("table_name", "bucket", "idx").agg(F.collect_set("size").alias("sizes"))
    third = F.floor(F.col("size") / HASHES)
    at = F.explode(F.array(*[F.pmod(F.xxhash64("ck", F.lit(salt * HASHES + j).cast("long")), third) + j * third for j in range(HASHES)]))
    sized = records.select("table_name", "bucket", "idx", "kh", "vh", "ck").join(wanted, ["table_name", "bucket", "idx"]).select("table_name", "bucket", "idx", "kh", "vh", "ck", F.explode("sizes").alias("size"))
    built = sized.select("table_name", "bucket", "idx", "size", "kh", "vh", "ck", at.alias("cell")).groupBy("table_name", "bucket", "idx", "size", "cell").agg(F.count("*").alias("n"), F.bit_xor("kh").alias("kh"), F.bit_xor("vh").alias("vh"), F.bit_xor("ck").alias("ck"))
    sides = F.explode(F.array(F.struct(F.col("idx").alias("pair"), F.lit(1).alias("s")), F.struct((F.col("idx") + 1).alias("pair"), F.lit(-1).alias("s"))))
    both = built.select("*", sides.alias("x")).select("table_name", "bucket", "x.pair", "size", "cell", (F.col("n") * F.col("x.s")).alias("n"), "kh", "vh", "ck").join(plan, ["table_name", "bucket", "pair", "size"], "left_semi")
    left = both.groupBy("table_name", "bucket", "pair", "size", "cell").agg(F.sum("n").alias("n"), F.bit_xor("kh").alias("kh"), F.bit_xor("vh").alias("vh"), F.bit_xor("ck").alias("ck"))
    return left.where("n <> 0 or kh <> 0 or vh <> 0 or ck <> 0")


def peel(cells: np.ndarray, n: np.ndarray, kh: np.ndarray, vh: np.ndarray, ck: np.ndarray, size: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(key hashes, value hashes, signs) of a subtracted table, or None where it doesn't come apart or its digest is off."""
    third = size // HASHES
    N, K, V, C = (np.zeros(size, dtype=np.int64) for _ in range(4))
    N[cells], K[cells], V[cells], C[cells] = n, kh, vh, ck
    digest = int(np.bitwise_xor.reduce(C[:third])), int(N[:third].sum())
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(2 * size + 2):
        pure = np.flatnonzero(np.abs(N) == 1)
        pure = pure[xxhash64(K[pure], V[pure]) == C[pure]]
        if not len(pure):
            break
        _, first = np.unique(C[pure], return_index=True)
        at = pure[first]
        k, v, c, s = K[at].copy(), V[at].copy(), C[at].copy(), N[at].copy()
        found.append((k, v, s))
        for j in range(HASHES):
            where = xxhash64(c, np.full(len(c), salt * HASHES + j, dtype=np.int64)) % third + j * third
            np.subtract.at(N, where, s)
            for A, x in ((K, k), (V, v), (C, c)):
                np.bitwise_xor.at(A, where, x)
    if N.any() or K.any() or V.any() or C.any():
        return None
    k, v, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    if (int(np.bitwise_xor.reduce(xxhash64(k, v))) if len(k) else 0, int(s.sum())) != digest:
        return None
    return k, v, s


def _peeler(salt: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name, bucket, pair, size = pdf["table_name"].iat[0], pdf["bucket"].iat[0], pdf["pair"].iat[0], int(pdf["size"].iat[0])
        got = peel(*(pdf[c].to_numpy(dtype=np.int64) for c in ("cell", "n", "kh", "vh", "ck")), size - size % HASHES, salt)
        k = np.unique(got[0]) if got else np.zeros(1, np.int64)
        return pd.DataFrame({"table_name": name, "bucket": bucket, "pair": pair, "size": size, "kh": k, "ok": got is not None})

    return run


def snapshot_changes(records: DataFrame, tolerance: float = 1e-6, bucket_records: int = BUCKET_RECORDS, least_cells: int = LEAST_CELLS) -> DataFrame:
    """(table_name, record_key, load, change_kind) from the rows of latest_records, of any number of tables united.

    A group of one bucket and pair of loads holds at most a lookup table's cells, so no task gets an unbounded group.
    """
    base = materialize(hashed(records))
    sizes = base.groupBy("table_name", "load").agg(F.count("*").alias("n"))
    loads = materialize(sizes.withColumn("idx", F.row_number().over(Window.partitionBy("table_name").orderBy("load"))))  # as many rows as there are loads
    n_loads, per_load = loads.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    loads, buckets = loads.drop("n"), max(1, -(-per_load // bucket_records))
    recs = base.join(F.broadcast(loads) if n_loads <= 10_000 else loads, ["table_name", "load"]).withColumn("bucket", F.pmod(F.shiftrightunsigned("kh", 17), F.lit(buckets)))
    last = loads.groupBy("table_name").agg(F.max("idx").alias("last"))
    plan, done, failed = materialize(planned(recs, F.broadcast(last) if n_loads <= 10_000 else last, least_cells)), None, None
    for salt in range(MAX_ROUNDS):
        out = materialize(tables(recs, plan, salt).groupBy("table_name", "bucket", "pair").applyInPandas(_peeler(salt), PEELED))
        done = out.where("ok") if done is None else done.unionByName(out.where("ok"))
        failed = out.where("not ok").select("table_name", "bucket", "pair", (F.col("size") * GROWTH).alias("size"))
        if failed.isEmpty():
            failed = None
            break
        plan = failed
    keys = done.select("table_name", "pair", "kh")
    if failed is not None:  # never seen; a bucket that still fails is compared whole
        whole = recs.join(failed.select("table_name", "bucket", F.col("pair"), F.explode(F.array("pair", F.col("pair") - 1)).alias("idx")), ["table_name", "bucket", "idx"]).select("table_name", "pair", "kh").distinct()
        keys = keys.unionByName(whole)
    sides = keys.select("table_name", "pair", "kh", F.explode(F.array(F.col("pair"), F.col("pair") - 1)).alias("idx"))
    rows = sides.join(recs.select("table_name", "kh", "idx", "record_key", "vals"), ["table_name", "kh", "idx"])
    # By the key itself: records whose keys share a hash are compared each on its own
    pairs = rows.groupBy("table_name", "pair", "kh", "record_key").agg(F.max(F.when(F.col("idx") == F.col("pair"), F.struct("vals"))).alias("new"), F.max(F.when(F.col("idx") < F.col("pair"), F.struct("vals"))).alias("old"))
    differs = F.exists(F.zip_with("new.vals", "old.vals", lambda a, b: F.when(a.isNull() & b.isNull(), False).when(a.isNull() | b.isNull(), True).when(a == b, False).otherwise(F.coalesce(F.abs(a - b) > tolerance * F.greatest(F.abs(a), F.abs(b)), F.lit(True)) | (F.abs(a) == float("inf")) | (F.abs(b) == float("inf")))), lambda x: x)
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(differs, "changed")
    out = pairs.withColumn("change_kind", kind).where("change_kind is not null").select("table_name", "record_key", F.col("pair").alias("idx"), "change_kind")
    return out.join(F.broadcast(loads) if n_loads <= 10_000 else loads, ["table_name", "idx"]).select("table_name", "record_key", "load", "change_kind")
