"""Mixing sources to target weights: hash-random order, prefix sums, exact cut.

Every record gets a hash-random key. Keys are cut into ranges, in which records are sorted and summed up within their source;
with the ranges' own sums this gives each record its place on the source's token line, without one task ever holding a source.
A source's budget is its share of the total. Whole epochs go in as often as the budget allows, the last one is cut where the
sum comes nearest to the budget. The total, where none is given, is the largest that no source's cap on repeats stands against.

Edge cases: null, blank and unknown sources belong to no target and are reported with none drawn; names are compared without case,
blanks, '-' and '_'; records of no tokens are drawn with their neighbours; ties of the key go by id; a target without records
gets nothing and doesn't bound the total; repeated ids are separate records; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

RANGE_ROWS = 20_000


def source_key(c: Column) -> Column:
    """Letters and digits of a source's name, lower case; null for blank."""
    key = F.lower(F.regexp_replace(c, r"[\s_\-]+", ""))
    return F.when(key != "", key)


def budgets(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """One row per target: source, key, share, max_repeats, have (tokens at hand), budget, epochs (whole ones), rest (tokens of the last)."""
    t = targets.where("source is not null and target_share > 0").select("source", source_key(F.col("source")).alias("key"), F.col("target_share").alias("share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(1)).alias("max_repeats"))
    have = t.join(sizes, "key", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    reach = have.where("have > 0").agg(F.min(F.col("have") * F.col("max_repeats") / F.col("share"))).scalar() if total is None else F.lit(float(total))
    b = have.withColumn("total", reach)
    budget = F.least(F.floor(F.coalesce("total", F.lit(0.0)) * F.col("share") + 1e-6).cast("long"), F.col("have") * F.col("max_repeats"))
    return b.withColumn("budget", budget).withColumn("epochs", F.coalesce(F.try_divide("budget", "have"), F.lit(0)).cast("int")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("have"))


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, doc_id: str = "doc_id", size: str = "n_tokens", source: str = "source", seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(drawn, report). drawn: source, doc id, epoch (from 1), n_tokens. docs is read three times: materialise costly sizes first."""
    rows = docs.select(F.col(doc_id).alias("id"), source_key(F.col(source)).alias("key"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias("n"))
    sizes = rows.where("key is not null").groupBy("key").agg(F.sum("n").alias("have"), F.count("*").alias("records"))
    plan = budgets(sizes, targets, total)
    ranges = max(1, -(-docs.count() // RANGE_ROWS))
    few = targets.count() <= 10_000
    plan = F.broadcast(plan) if few else plan
    keyed = rows.join(plan.select("key", "source", "epochs", "rest"), "key").withColumn("u", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40)))
    keyed = keyed.withColumn("range", F.floor(F.col("u") * ranges / F.lit(1 << 40)).cast("long"))
    sums = keyed.groupBy("key", "range").agg(F.sum("n").alias("s"))
    up = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("key", "range", F.coalesce(F.sum("s").over(up), F.lit(0)).alias("start"), "s")
    # Only the range that holds the cut needs sorting; ranges before it go in whole, ranges after it stay out
    placed = keyed.join(starts, ["key", "range"])
    whole = placed.where("start + s <= rest").select("source", "id", "n", "epochs", F.lit(True).alias("last"))
    none = placed.where("start >= rest").select("source", "id", "n", "epochs", F.lit(False).alias("last"))
    cut = placed.where("start + s > rest and start < rest")
    line = Window.partitionBy("key", "range").orderBy("u", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("upto", F.col("start") + F.sum("n").over(line))
    # What the record across the cut leaves free goes to later records of the range that still fit
    inside = F.col("upto") <= F.col("rest")
    cut = cut.withColumn("inside", inside).withColumn("gap", F.col("rest") - F.greatest(F.max(F.when(inside, F.col("upto"))).over(Window.partitionBy("key", "range")), F.col("start")))
    cut = cut.withColumn("gap", F.coalesce("gap", F.col("rest") - F.col("start")))
    fits = ~F.col("inside") & (F.col("n") <= F.col("gap"))
    more = F.sum(F.when(fits, F.col("n")).otherwise(0)).over(line)
    cut = cut.withColumn("last", F.col("inside") | (fits & (more <= F.col("gap")))).select("source", "id", "n", "epochs", "last")
    placed = whole.unionByName(none).unionByName(cut)
    times = placed.withColumn("times", F.col("epochs") + F.col("last").cast("int")).where("times > 0")
    drawn = times.select("source", F.col("id").alias(doc_id), F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch"), F.col("n").alias("n_tokens"))
    got = drawn.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("records"), F.max("epoch").alias("most_repeats"))
    report = plan.select("source", F.col("share").alias("target_share"), "max_repeats", F.col("have").alias("tokens_at_hand"), "budget").join(got, "source", "left")
    report = report.withColumn("tokens", F.coalesce("tokens", F.lit(0))).withColumn("records", F.coalesce("records", F.lit(0))).withColumn("most_repeats", F.coalesce("most_repeats", F.lit(0)))
    report = report.withColumn("share", F.coalesce(F.try_divide("tokens", report.agg(F.sum("tokens")).scalar()), F.lit(0.0)))
    return drawn, report
