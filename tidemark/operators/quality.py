"""Column-level data quality: exact base aggregates beside a classifier two-sample test.

Base aggregates come from one pass that counts every value of every column of every load, and a second over those counts: rows,
missing, distinct, least, greatest, most frequent value, exact median, pattern violations. Beside them a distributed
logistic regression learns, for each pair of consecutive loads, to tell the newer from the older one by one-hot bins of all numeric
columns, until it has converged. It is cross-fitted in two folds, with an area of its own for each; the area under the curve of each column's own part, and what the whole model loses
without the column, say which columns' distributions moved. Bins are those of the two loads alone, so that other loads don't matter.
Where a movement that matters can't be excluded, exact aggregates decide.

Edge cases: null and NaN are missing, infinities are values but not finite; marker rows are left out beforehand; a load without
finite values has no median; the first load has nothing to be compared with; ties of the most frequent value don't change its share;
an empty table gives empty results; a column name may be any string.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize, release

QUANTILES, FOLDS, SCORE_BINS = 10, 2, 128
#: A model is fitted until its scaled squared gradient is below 1 and TOLERANCE a row, for MOST_ROUNDS evaluations at most; PENALTY of a squared weight.
TOLERANCE, MOST_ROUNDS, PENALTY, PAIRS_AT_ONCE = 1e-6, 200, 0.25, 200
#: What is an issue: the missing share's rise, the median's factor, the rise of the most frequent value's share.
NULLS, LEVEL, HEAPING, SIGMAS = 0.2, 3.0, 0.25, 2.5
#: Bins of a column: missing, minus and plus infinity, then ranges. QUANTILES must meet a value of a share above HEAPING twice, so that it has a bin of its own.
FIRST_RANGE = 3


def value_counts(rows: DataFrame, table_name: str, columns: list[str], load: str = "trading_date") -> DataFrame:
    """table_name, load, column_name, number, num DOUBLE, txt STRING, c: how often each value occurs. Map-side combine makes the shuffle as large as the distinct values."""
    kinds = dict(rows.dtypes)
    cells = []
    for c in columns:
        number = kinds[c] in ("double", "float", "bigint", "int", "smallint", "tinyint")
        v = F.col(f"`{c}`")
        num = F.when(~F.isnan(v.cast("double")), v.cast("double")) if number else F.lit(None).cast("double")
        cells.append(F.struct(F.lit(c).alias("column_name"), num.alias("num"), (F.lit(None).cast("string") if number else v.cast("string")).alias("txt"), F.lit(number).alias("number")))
    long = rows.select(F.col(load).alias("load"), F.explode(F.array(*cells)).alias("x")).select("load", "x.*")
    return long.groupBy(F.lit(table_name).alias("table_name"), "load", "column_name", "number", "num", "txt").agg(F.count("*").alias("c"))


def median_of(counts: DataFrame) -> DataFrame:
    """Exact median of the finite values of each (table, load, column): the bucket that holds the middle ranks is found first, then ranked alone."""
    keys = ["table_name", "load", "column_name"]
    fin = counts.where(F.col("num").isNotNull() & (F.abs("num") < float("inf")))
    # Order-preserving buckets: sign, binary exponent, 1/256 of an octave
    size = F.greatest(F.abs("num"), F.lit(1e-290))
    e = F.floor(F.log2(size))
    bucket = F.when(F.col("num") == 0, F.lit(0)).otherwise(F.signum("num").cast("long") * (e * 256 + F.least(F.floor((size / F.pow(F.lit(2.0), e) - 1) * 256), F.lit(255)) + 1_000_000))
    b = fin.withColumn("b", bucket.cast("long"))
    sizes = b.groupBy(*keys, "b").agg(F.sum("c").alias("c"))
    w = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = sizes.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy(*keys)))
    lo, hi = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    held = held.withColumn("before", F.col("upto") - F.col("c")).where(((lo >= F.col("before")) & (lo < F.col("upto"))) | ((hi >= F.col("before")) & (hi < F.col("upto"))))
    inside = b.join(held.select(*keys, "b", "before", "n"), [*keys, "b"])
    w2 = Window.partitionBy(*keys, "b").orderBy("num").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("upto", F.col("before") + F.sum("c").over(w2)).withColumn("from", F.col("upto") - F.col("c"))
    at = lambda r: F.max(F.when((r >= F.col("from")) & (r < F.col("upto")), F.col("num")))
    return ranked.groupBy(*keys).agg(((at(lo) + at(hi)) / 2).alias("median"))


def base_profile(counts: DataFrame, violations: DataFrame | None = None) -> DataFrame:
    """One row per (table, load, column) with the base aggregates; violations are null where no rule is checked. Only the most frequent value goes by six decimals."""
    keys = ["table_name", "load", "column_name"]
    given = F.when(F.col("number"), F.col("num").isNotNull()).otherwise(F.col("txt").isNotNull() & ~F.coalesce(F.col("txt").rlike(r"^\s*$"), F.lit(False)))
    agg = counts.groupBy(*keys).agg(
        F.sum("c").alias("n_rows"), F.coalesce(F.sum(F.when(~given, F.col("c"))), F.lit(0)).alias("n_missing"), F.count_if(given).alias("n_distinct"),
        F.min(F.when(given, F.col("num"))).alias("least"), F.max(F.when(given, F.col("num"))).alias("greatest"),
        F.min(F.when(given, F.col("txt"))).alias("first_text"), F.max(F.when(given, F.col("txt"))).alias("last_text"),
    )
    alike = counts.where(given).groupBy(*keys, F.round("num", 6).alias("num"), "txt").agg(F.sum("c").alias("c"))
    out = agg.join(alike.groupBy(*keys).agg(F.max("c").alias("mode_count")), keys, "left").withColumn("mode_count", F.coalesce("mode_count", F.lit(0)))
    out = out.join(median_of(counts), keys, "left")
    out = out.join(violations, keys, "left") if violations is not None else out.withColumn("violations", F.lit(None).cast("long"))
    return out.withColumn("missing_share", F.col("n_missing") / F.col("n_rows")).withColumn("mode_share", F.coalesce(F.try_divide("mode_count", F.col("n_rows") - F.col("n_missing")), F.lit(0.0)))


def rule_violations(rows: DataFrame, table_name: str, rules: dict[str, Column], load: str = "trading_date") -> DataFrame:
    """How many rows of each load break a column's rule (true = broken)."""
    aggs = rows.groupBy(F.col(load).alias("load")).agg(*[F.count_if(r).alias(c) for c, r in rules.items()])
    return aggs.select(F.lit(table_name).alias("table_name"), "load", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in rules])).alias("x")).select("table_name", "load", "x.*")


def _numbers(columns: list[str]) -> Column:
    return F.array(*[F.round(F.col(f"`{c}`").cast("double"), 6) for c in columns])


def _edges(rows: DataFrame, columns: list[str], load: str, loads: list[str]) -> dict[int, list[list[float]]]:
    """By number of the newer load: edges of each column's bins, from the quantiles of the pair's own two loads. A value that is two quantiles of a load has a bin of its own. Loads times columns times QUANTILES numbers come to the driver."""
    long = rows.where(F.col(load).isin(loads)).select(F.col(load).alias("load"), F.posexplode(_numbers(columns)).alias("i", "v")).where("v is not null and not isnan(v) and abs(v) < double('infinity')")
    got = long.groupBy("load", "i").agg(F.percentile_approx("v", [(i + 1) / (QUANTILES + 1) for i in range(QUANTILES)], 2000).alias("q")).collect()
    own: dict[tuple[str, int], set[float]] = {}
    for r in got:
        q = r["q"]
        own[r["load"], r["i"]] = {*q, *[float(np.nextafter(x, np.inf)) for x, y in zip(q, q[1:]) if x == y]}
    return {i: [sorted(own.get((loads[i - 2], c), set()) | own.get((loads[i - 1], c), set())) for c in range(len(columns))] for i in range(2, len(loads) + 1)}


def _bins(v: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    out = np.empty(v.shape, dtype=np.uint8)
    for c, e in enumerate(edges):
        out[:, c] = FIRST_RANGE + np.searchsorted(np.array(e), v[:, c], side="right")
    out[np.isnan(v)], out[np.isneginf(v)], out[np.isposinf(v)] = 0, 1, 2
    return out


def _binner(table_name: str, edges: dict[int, list[list[float]]]):
    """Blocks of rows of one pair of loads, fold and label (1: newer load); bins has a byte per row and column."""

    def run(batches):
        for pdf in batches:
            out = []
            for (i, f), g in pdf.groupby(["idx", "fold"], sort=False):
                v = np.array(g["v"].tolist(), dtype=float).reshape(len(g), -1)
                out += [(table_name, pair, f, label, _bins(v, edges[pair]).tobytes()) for pair, label in ((i, 1), (i + 1, 0)) if pair in edges]
            yield pd.DataFrame(out, columns=["table_name", "pair", "fold", "label", "bins"])

    return run


def binned(rows: DataFrame, table_name: str, columns: list[str], at: DataFrame, edges: dict[int, list[list[float]]], load: str, row_id: str) -> DataFrame:
    """table_name, pair (number of its newer load), fold, label, bins: where each number lies among the pair's edges. A row is in the pair that it is the newer load of and in the next."""
    slim = rows.select(F.lit(table_name).alias("table_name"), F.col(load).alias("load"), F.pmod(F.xxhash64(row_id), F.lit(FOLDS)).cast("int").alias("fold"), _numbers(columns).alias("v"))
    return slim.join(F.broadcast(at), ["table_name", "load"]).mapInPandas(_binner(table_name, edges), "table_name string, pair int, fold int, label int, bins binary")


Key = tuple[str, int, int]
Weights = dict[Key, np.ndarray]
#: First flat bin number of every column of a (table, pair), and their number
Starts = dict[tuple[str, int], np.ndarray]


def _blocks(pdf: pd.DataFrame, starts: Starts):
    """(table, pair, fold, label, flat bin numbers) of a batch."""
    for t, pair, fold, label, raw in pdf.itertuples(index=False):
        at = starts[t, pair]
        yield t, int(pair), int(fold), int(label), np.frombuffer(raw, dtype=np.uint8).reshape(-1, len(at) - 1) + at[:-1]


def _sent(sums: Weights):
    for (t, pair, fold), x in sums.items():
        yield pd.DataFrame({"table_name": [t], "pair": [pair], "fold": [fold], "x": [x.tobytes()]})


def _counts(starts: Starts):
    """Per partition: how many rows of each label have which bin."""

    def run(batches):
        sums: Weights = {}
        for pdf in batches:
            for t, pair, fold, label, flat in _blocks(pdf, starts):
                size = int(starts[t, pair][-1])
                sums.setdefault((t, pair, fold), np.zeros((2, size)))[label] += np.bincount(flat.ravel(), minlength=size)
        yield from _sent(sums)

    return run


def _losses(trial: Weights, starts: Starts):
    """Per partition: gradient and log loss of every model in trial, which leaves out its own fold."""

    def run(batches):
        sums: Weights = {}
        for pdf in batches:
            for t, pair, fold, label, flat in _blocks(pdf, starts):
                for key in ((t, pair, held) for held in range(FOLDS) if held != fold and (t, pair, held) in trial):
                    w, size = trial[key], int(starts[t, pair][-1])
                    z = w[flat].sum(axis=1) + w[size]
                    r = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - label
                    out = sums.setdefault(key, np.zeros(size + 2))
                    out[:size] += np.bincount(flat.ravel(), np.repeat(r, flat.shape[1]), minlength=size)
                    out[size] += r.sum()
                    out[size + 1] += (np.logaddexp(0, z) - label * z).sum()
        yield from _sent(sums)

    return run


def _auc_hist(weights: Weights, starts: Starts):
    """Per partition: for every pair, fold, label and part of the model, how many rows have which score. Part 0: all columns; 1 + c: without column c."""

    def run(batches):
        sums: Weights = {}
        for pdf in batches:
            for t, pair, fold, label, flat in _blocks(pdf, starts):
                if (t, pair, fold) not in weights:
                    continue
                w, n = weights[t, pair, fold], 1 + flat.shape[1]
                part = w[flat]
                score = part.sum(axis=1) + w[-1]
                parts = np.concatenate([score[:, None], score[:, None] - part], axis=1)
                at = np.minimum((SCORE_BINS / (1 + np.exp(-np.clip(parts, -30, 30)))).astype(np.int64), SCORE_BINS - 1)
                sums.setdefault((t, pair, fold), np.zeros((2, n * SCORE_BINS)))[label] += np.bincount((at + np.arange(n) * SCORE_BINS).ravel(), minlength=n * SCORE_BINS)
        yield from _sent(sums)

    return run


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.iloc[:1].assign(x=[sum(np.frombuffer(x) for x in pdf["x"]).tobytes()])


def _summed(rows: DataFrame, run) -> Weights:
    """Vectors of the partitions added up by key; models times width come to the driver, whatever the rows."""
    kind = "table_name string, pair int, fold int, x binary"
    return {(r[0], r[1], r[2]): np.frombuffer(r[3]) for r in rows.mapInPandas(run, kind).groupBy("table_name", "pair", "fold").applyInPandas(_add, kind).collect()}


class _Fit:
    """Limited-memory BFGS of one model's penalised log loss, one evaluation at a time: `trial` is to be evaluated, `tell` takes the result. Weights are scaled by their bins' curvature at 0."""

    def __init__(self, counts: np.ndarray, columns: int):
        n = counts.sum(axis=1) / columns
        self.n, self.columns = n.sum(), columns
        self.scale = 1 / np.sqrt(np.append(0.25 * counts.sum(axis=0) + 2 * PENALTY, 0.25 * self.n + 2 * PENALTY))
        self.u = np.zeros(len(self.scale))
        self.u[-1] = np.log((n[1] + 0.5) / (n[0] + 0.5)) / self.scale[-1]
        self.f, self.g, self.kept = np.inf, np.zeros_like(self.u), []
        self.direction, self.step, self.done = np.zeros_like(self.u), 0.0, False

    def trial(self) -> np.ndarray:
        return (self.u + self.step * self.direction) * self.scale

    def tell(self, x: np.ndarray) -> None:
        w = self.trial()
        f, g = x[-1] + PENALTY * (w[:-1] ** 2).sum(), (x[:-1] + 2 * PENALTY * np.append(w[:-1], 0)) * self.scale
        if self.step and f > self.f + 1e-4 * self.step * (self.g @ self.direction) + 1e-12 * abs(self.f):
            self.step /= 2
            return
        if self.step:
            s, y = self.step * self.direction, g - self.g
            if s @ y > 1e-12 * (y @ y):
                self.kept = [*self.kept[-9:], (s, y)]
            self.u = self.u + s
        self.f, self.g = f, g
        self.done = bool(g @ g <= 1 + TOLERANCE * self.n)  # chance alone makes it about as large as there are bins
        q, back = -g, []
        for s, y in reversed(self.kept):
            back.append((s @ q) / (s @ y))
            q = q - back[-1] * y
        # A row moves one bin of every column and the constant, so the curvature is at most 1 + columns
        q = q * ((self.kept[-1][0] @ self.kept[-1][1]) / (self.kept[-1][1] @ self.kept[-1][1]) if self.kept else 1 / (1 + self.columns))
        for (s, y), b in zip(self.kept, reversed(back), strict=True):
            q = q + s * (b - (y @ q) / (s @ y))
        self.direction, self.step = q, 1.0


def _fitted(rows: DataFrame, counts: Weights, starts: Starts) -> dict[Key, _Fit]:
    """Every model fitted until its gradient is lost in its rows' noise; those not done after MOST_ROUNDS say so."""
    fits: dict[Key, _Fit] = {}
    for t, pair in starts:
        for held in range(FOLDS):
            others = [counts[t, pair, f] for f in range(FOLDS) if f != held and (t, pair, f) in counts]
            if others:
                fits[t, pair, held] = _Fit(sum(others).reshape(2, -1), len(starts[t, pair]) - 1)
    for k in range(MOST_ROUNDS):
        trial = {key: m.trial() for key, m in fits.items() if not m.done}
        if not trial:
            break
        for key, x in _summed(rows, _losses(trial, starts)).items():
            fits[key].tell(x)
        if k % 8 == 7:
            release(rows.sparkSession)
    return fits


def _auc(n: np.ndarray, scores: np.ndarray | None = None) -> float:
    """Area under the curve of counts by label and score; scores: of the counts' columns, which are in order where it is left out."""
    if scores is not None:
        level = np.unique(scores, return_inverse=True)[1]
        n = np.stack([np.bincount(level, x) for x in n])
    return float((n[1] * (np.cumsum(n[0]) - n[0] / 2)).sum() / (n[0].sum() * n[1].sum()))


def least_auc(moved: float | Column) -> float | Column:
    """The least area that a column's best score has where so large a share of the rows moved between bins: half of it above 1/2, as the best score's curve is concave. A hair less, for rounding."""
    return 0.5 + moved / 2 - 1e-9


def _pairs_drift(tables: dict[str, tuple[DataFrame, list[str]]], names: dict[str, list[str]], pairs: list[tuple[str, int]], load: str, row_id: str) -> list[tuple]:
    """What `drift` returns for some pairs."""
    spark = next(iter(tables.values()))[0].sparkSession
    rows, starts = None, {}
    for t in dict.fromkeys(t for t, _ in pairs):
        df, cols = tables[t]
        wanted = [p for u, p in pairs if u == t]
        first = wanted[0] - 2  # the pairs of a table follow one another
        mine = {p + first: e for p, e in _edges(df, cols, load, names[t][first : wanted[-1]]).items()}
        at = spark.createDataFrame([(t, names[t][i - 1], i) for i in sorted({*mine, *[p - 1 for p in mine]})], "table_name string, load string, idx int")
        part = binned(df, t, cols, at, mine, load, row_id)
        rows = part if rows is None else rows.unionByName(part)
        starts |= {(t, p): np.cumsum([0, *[len(x) + FIRST_RANGE + 1 for x in e]]) for p, e in mine.items()}
    rows = materialize(rows)
    counts = {key: x.reshape(2, -1) for key, x in _summed(rows, _counts(starts)).items()}
    fits = _fitted(rows, counts, starts)
    weights = {key: m.u * m.scale for key, m in fits.items()}
    hist = _summed(rows, _auc_hist(weights, starts))
    out = []
    for t, pair in pairs:
        cols, at, folds = tables[t][1], starts[t, pair], []
        for f in range(FOLDS):
            if (t, pair, f) not in hist:
                continue
            h, c = hist[t, pair, f].reshape(2, 1 + len(cols), SCORE_BINS), counts[t, pair, f]
            n = h[:, 0].sum(axis=1)
            if n.all():
                parts = [_auc(h[:, k]) for k in range(1 + len(cols))] + [_auc(c[:, i:j], weights[t, pair, f][i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
                folds.append((n[0] * n[1], np.array(parts)))
        # Scores of different models aren't comparable: each fold has an area of its own
        auc = sum(x * a for x, a in folds) / sum(x for x, _ in folds) if folds else np.full(1 + 2 * len(cols), np.nan)
        both = sum(counts[t, pair, f] for f in range(FOLDS) if (t, pair, f) in counts)
        n = both[:, at[0] : at[1]].sum(axis=1)
        se = float(np.sqrt((n.sum() + 1) / (12 * max(1.0, sum(x for x, _ in folds) * FOLDS))))
        done = all(fits[t, pair, f].done for f in range(FOLDS) if (t, pair, f) in fits)
        for c, name in enumerate(cols):
            only, without = float(auc[1 + len(cols) + c]), float(auc[1 + c])
            mine = both[:, at[c] : at[c + 1]]
            best = _auc(mine, mine[1] / np.maximum(mine.sum(axis=0), 1))
            high = max(only, 0.5 + float(auc[0]) - without) + SIGMAS * se
            reach = max(best, high) if done and folds else 1.0
            given = 1 - mine[:, 0] / n
            out.append((t, names[t][pair - 1], name, int(n[0]), int(n[1]), float(auc[0]), only, without, float(auc[0]) - without, reach, bool(reach >= min(least_auc(NULLS), least_auc(HEAPING * given.min())))))
    return out


def drift(tables: dict[str, tuple[DataFrame, list[str]]], load: str = "trading_date", row_id: str = "row_id") -> DataFrame:
    """table_name, load, column_name, n_old, n_new, model_auc, only_auc, without_auc, ablation, reach, candidate for every pair of consecutive loads.

    tables: name -> (rows, numeric columns). Rows are read as bytes once per evaluation of the models; the driver holds the models of PAIRS_AT_ONCE pairs.
    reach: what the column's discrimination may be at most: the area of the best score of its bins, or the upper confidence bound of the model's; 1 where a model didn't converge or can't be judged.
    candidate: more values may have gone missing or be the same one than the rules allow. A median may move by any factor with a single row, so nothing speaks against a change of level.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    names = {t: sorted(r[0] for r in df.select(load).distinct().collect() if r[0] is not None) for t, (df, _) in tables.items()}
    pairs = [(t, i) for t, x in names.items() for i in range(2, len(x) + 1)]
    out = []
    for k in range(0, len(pairs), PAIRS_AT_ONCE):
        out += _pairs_drift(tables, names, pairs[k : k + PAIRS_AT_ONCE], load, row_id)
        release(spark)
    return spark.createDataFrame(out, "table_name string, load string, column_name string, n_old long, n_new long, model_auc double, only_auc double, without_auc double, ablation double, reach double, candidate boolean")


def load_issues(base: DataFrame, moved: DataFrame, columns: list[tuple[str, str]], nulls: float = NULLS, level: float = LEVEL, heaping: float = HEAPING) -> DataFrame:
    """table_name, column_name, load, issue. Nulls and heaping are looked for where the classifier can't exclude them, changes of level everywhere."""
    wanted = F.lit(False)
    for t, c in columns:
        wanted = wanted | ((F.col("table_name") == t) & (F.col("column_name") == c))
    w = Window.partitionBy("table_name", "column_name").orderBy("load")
    b = base.where(wanted).select("table_name", "column_name", "load", "missing_share", "median", "mode_share", "violations", *[F.lag(x).over(w).alias(f"{x}_0") for x in ("missing_share", "median", "mode_share")])
    b = b.join(moved.select("table_name", "column_name", "load", "reach"), ["table_name", "column_name", "load"], "left").withColumn("reach", F.coalesce("reach", F.lit(1.0)))
    # A share of the given values is a smaller share of the rows
    given = 1 - F.greatest("missing_share", "missing_share_0")
    tests = [
        (F.col("violations") > 0, "range"),
        ((F.col("reach") >= least_auc(nulls)) & (F.col("missing_share") - F.col("missing_share_0") > nulls), "nulls"),
        ((F.col("median") > level * F.col("median_0")) | (F.col("median") < F.col("median_0") / level), "level"),
        ((F.col("reach") >= least_auc(heaping * given)) & (F.col("mode_share") - F.col("mode_share_0") > heaping), "heaping"),
    ]
    return b.select("table_name", "column_name", "load", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(n)) for t, n in tests]))).alias("issue"))
