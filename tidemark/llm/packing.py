"""Filling fixed-capacity containers with items: minimum bin slack.

An item larger than the capacity gives full pieces, which fill a container each, and a rest. Rests and smaller items are spread
over shards of bounded size by hash. Within a shard each container is opened with the largest item left, and a subset-sum dynamic
programme over the available lengths, held as the bits of one integer, finds the fullest combination of others that still fits;
these are removed and the next container is opened. A combination that leaves nothing free ends the search at once.

Edge cases: null and negative sizes count as 0; items of size 0 join a container of their shard without taking space; ties of
length go by id; items without an id can't be assigned and are left out; capacities that are null or below 1 are left out; equal items are all packed; an empty table gives no rows.
"""

from __future__ import annotations

import random
from bisect import bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ITEMS, FIRST_TRIES = 10_000, 48


def fullest(lens: list[int], count: dict[int, int], room: int, rng: random.Random) -> list[int]:
    """Lengths (a multiset) with the greatest sum that is at most room. lens: distinct available lengths, ascending."""
    m = bisect_right(lens, room)
    if not m or room <= 0:
        return []
    if count.get(room):
        return [room]
    order = [lens[i] for i in (rng.sample(range(m), FIRST_TRIES) if m > FIRST_TRIES else range(m - 1, -1, -1))]
    limit, goal = (1 << (room + 1)) - 1, 1 << room
    for whole in (m <= FIRST_TRIES, True):
        if whole:
            # Every copy takes part, in powers of two, the longest first
            parts = []
            for n in reversed(lens[:m]):
                c, k = min(count[n], room // n), 1
                while c > 0:
                    k = min(k, c)
                    parts.append((n, k))
                    c, k = c - k, k * 2
        else:
            parts = [(n, 1) for n in order]
        bits, before = 1, []
        for n, k in parts:
            before.append(bits)
            bits |= (bits << (n * k)) & limit
            if bits & goal:
                break
        if bits & goal or whole:
            left, out = bits.bit_length() - 1, []
            for (n, k), b in zip(reversed(parts[: len(before)]), reversed(before), strict=True):
                if not b >> left & 1:
                    out += [n] * k
                    left -= n * k
            return out
    return []


def pack(sizes: list[int], capacity: int, seed: int = 7) -> list[int]:
    """Container number of each item, in the order given; every size is at most capacity."""
    rng = random.Random(seed)
    by_len: dict[int, list[int]] = {}
    for at in range(len(sizes) - 1, -1, -1):
        by_len.setdefault(sizes[at], []).append(at)
    zero = by_len.pop(0, [])
    lens: list[int] = []
    for n in by_len:
        insort(lens, n)
    count = {n: len(x) for n, x in by_len.items()}
    out, bins = [0] * len(sizes), 0

    def take(n: int) -> None:
        out[by_len[n].pop()] = bins
        count[n] -= 1
        if not count[n]:
            del lens[bisect_right(lens, n) - 1]

    while lens:
        big = lens[-1]
        take(big)
        for n in fullest(lens, count, capacity - big, rng):
            take(n)
        bins += 1
    for at in zero:
        out[at] = 0
    return out


def pack_items(items: DataFrame, capacities: list[tuple[str, int]], item_id: str = "doc_id", size: str = "n_tokens", shard_items: int = SHARD_ITEMS) -> DataFrame:
    """run_name, container_id, item id, piece_no, piece_start, piece_size, capacity. Shards keep a task's group at about shard_items items."""
    runs = [(n, int(c)) for n, c in capacities if n is not None and c is not None and c >= 1]
    items = items.where(F.col(item_id).isNotNull())
    n_items = items.count()
    shards = max(1, -(-n_items // shard_items))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("run_name"), F.lit(c).cast("long").alias("capacity")) for n, c in runs])) if runs else F.lit(None)
    if not runs:
        return items.sparkSession.createDataFrame([], f"run_name string, container_id string, {item_id} long, piece_no int, piece_start long, piece_size long, capacity long")
    s = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    base = items.select(F.col(item_id).cast("long").alias(item_id), s.alias("size"), each.alias("r")).select(item_id, "size", "r.*").withColumn("whole", F.floor(F.col("size") / F.col("capacity")).cast("int"))
    full = base.where("whole > 0").select("run_name", "capacity", item_id, F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("piece_no"))
    full = full.select("run_name", F.concat_ws("-", F.lit("f"), item_id, "piece_no").alias("container_id"), item_id, "piece_no", (F.col("piece_no") * F.col("capacity")).alias("piece_start"), F.col("capacity").alias("piece_size"), "capacity")
    rest = base.withColumn("part", F.col("size") - F.col("whole") * F.col("capacity")).where("part > 0 or whole = 0")
    rest = rest.select("run_name", "capacity", item_id, F.col("whole").alias("piece_no"), "part", F.pmod(F.xxhash64(item_id), F.lit(shards)).alias("shard"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([item_id, "piece_no"], kind="stable").reset_index(drop=True)
        pdf["bin"] = pack(pdf["part"].tolist(), int(pdf["capacity"].iat[0]))
        return pdf

    schema = f"run_name string, capacity long, {item_id} long, piece_no int, part long, shard long, bin int"
    done = rest.groupBy("run_name", "shard").applyInPandas(run, schema)
    done = done.select("run_name", F.concat_ws("-", F.lit("p"), "shard", "bin").alias("container_id"), item_id, "piece_no", (F.col("piece_no") * F.col("capacity")).alias("piece_start"), F.col("part").alias("piece_size"), "capacity")
    return full.unionByName(done)


def fill_report(packed: DataFrame) -> DataFrame:
    """run_name, capacity, containers, tokens, fill (tokens over what the containers could hold), cut_items."""
    by_bin = packed.groupBy("run_name", "capacity", "container_id").agg(F.sum("piece_size").alias("tokens"), F.count("*").alias("pieces"))
    return by_bin.groupBy("run_name", "capacity").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.sum("pieces").alias("pieces"), (F.sum("tokens") / (F.count("*") * F.first("capacity"))).alias("fill"))
