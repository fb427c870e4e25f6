"""Snapshot diff, panes, quality, history and as-of join on small frames, with the odd cases their docstrings define."""

import random
from datetime import UTC, date, datetime

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.oracle import connect
from tidemark.functions.xxh import xxhash64
from tidemark.operators import asof_join, history, panes, quality, snapshot_diff
from tidemark.plans import changes

NAN, INF = float("nan"), float("inf")


def test_xxhash_equals_spark(spark):
    values = [0, 1, -1, 2**62, -(2**63), 123456789]
    df = spark.createDataFrame([(v, v ^ 77) for v in values], "a long, b long").select(F.xxhash64("a").alias("h"), F.xxhash64("a", "b").alias("h2")).toPandas()
    a = np.array(values, dtype=np.int64)
    assert df.h.tolist() == xxhash64(a).tolist()
    assert df.h2.tolist() == xxhash64(a, a ^ 77).tolist()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**62), 2**62), max_size=40), st.sets(st.integers(-(2**62), 2**62), max_size=40), st.integers(0, 3))
def test_peel_recovers_the_difference(new, old, salt):
    size = 384
    cells: dict[int, list[int]] = {}
    for keys, sign in ((new, 1), (old, -1)):
        for key in keys:
            k, v = np.array([key]), np.array([key // 3])
            c = xxhash64(k, v)
            for j in range(3):
                at = int(xxhash64(c, np.array([salt * 3 + j]))[0] % (size // 3) + j * (size // 3))
                e = cells.setdefault(at, [0, 0, 0, 0])
                e[0] += sign
                e[1] ^= int(k[0])
                e[2] ^= int(v[0])
                e[3] ^= int(c[0])
    left = {a: e for a, e in cells.items() if any(e)}
    arrays = [np.array(x, dtype=np.int64) for x in (list(left), *zip(*left.values(), strict=True))] if left else [np.zeros(0, np.int64)] * 5
    k, v, s = snapshot_diff.peel(*arrays, size, salt)
    assert {(int(a), int(b)) for a, b in zip(k, s, strict=True)} == {(x, 1) for x in new - old} | {(x, -1) for x in old - new}


def test_peel_refuses_an_overfull_table():
    n = np.arange(1, 400, dtype=np.int64)
    c = xxhash64(n, n)
    assert snapshot_diff.peel(np.zeros(1, np.int64), np.array([399]), np.array([np.bitwise_xor.reduce(n)]), np.array([np.bitwise_xor.reduce(n)]), np.array([np.bitwise_xor.reduce(c)]), 3, 0) is None


def _records(spark, rows):
    """rows: key, load, row_id, at, x, y; idx, kh and vals are columns that clash with the operator's own."""
    df = spark.createDataFrame([(*r, 1, "clash", 2.0) for r in rows], "k string, load_day string, row_id long, at timestamp, x double, y double, idx int, kh string, vals double")
    return snapshot_diff.latest_records(df, "t", F.coalesce("k", F.lit("")), ["x", "y"], load="load_day")


def _brute(rows, tolerance=1e-6):
    best = {}
    for k, d, rid, at, x, y in rows:
        if d is None:
            continue
        key = (k or "", d)
        if key not in best or ((at or datetime.min), -rid) > best[key][0]:
            best[key] = (((at or datetime.min), -rid), tuple(None if v is None or v != v else v for v in (x, y)))
    days, out = sorted({d for _, d in best}), set()
    for a, b in zip(days, days[1:]):
        for k in {k for k, _ in best}:
            o, n = best.get((k, a)), best.get((k, b))
            if n and not o:
                out.add((k, b, "added"))
            elif o and not n:
                out.add((k, b, "removed"))
            elif o and n and any((p is None) != (q is None) or (p is not None and p != q and (abs(p) == INF or abs(q) == INF or abs(p - q) > tolerance * max(abs(p), abs(q)))) for p, q in zip(o[1], n[1])):
                out.add((k, b, "changed"))
    return out


def test_snapshot_changes_against_brute_force(spark):
    rng = random.Random(5)
    values = [None, NAN, INF, -INF, 0.0, 1.0, 1.0 + 1e-12, 1.0 + 5e-7, 1.0 + 2e-6, 9.9999999999, 10.0, 1e300, -3.5]
    t = [datetime(2026, 1, 1, h) for h in range(4)]
    rows = [(rng.choice([None, "", "A", "B", "C", *[f"s{i}" for i in range(60)]]), rng.choice([None, "d1", "d2", "d3", "d4"]), i, rng.choice(t), rng.choice(values), rng.choice(values)) for i in range(700)]
    rows += rows[:40]
    got = {tuple(r) for r in snapshot_diff.snapshot_changes(_records(spark, rows), bucket_records=16, least_cells=12).select("record_key", "load", "change_kind").collect()}
    assert got == _brute(rows)


def test_snapshot_changes_of_one_load_and_of_none(spark):
    one = [("A", "d1", 1, datetime(2026, 1, 1), 1.0, 2.0)]
    assert snapshot_diff.snapshot_changes(_records(spark, one)).count() == 0
    assert snapshot_diff.snapshot_changes(_records(spark, one).where("false")).count() == 0


REPORTS = "table_name string, symbol string, report_id long, row_id long, event_day date, arrival timestamp, value double, pane string"


def test_panes_against_brute_force(spark):
    """Late, repeated, revised and too late rows; nulls everywhere; a clashing column."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        day = date(2026, 3, rng.randint(1, 28))
        arrival = datetime(2026, 3, day.day) .timestamp() + rng.choice([3600, 86400 * 2, 86400 * 6.5, 86400 * 12, 86400 * 21.9, 86400 * 22.1, 86400 * 30])
        rows.append(("t", rng.choice([None, "A", "B"]), rng.choice([None, *range(40)]), i, rng.choice([day, None]) if rng.random() < 0.1 else day, datetime.fromtimestamp(arrival, UTC).replace(tzinfo=None) if rng.random() > 0.05 else None, rng.choice([None, NAN, 1.0, 2.0, 2.0]), "x"))
    # A report keeps one day and symbol
    fixed = {}
    rows = [(t, *fixed.setdefault(r, (s, d)), r, i, a, v, x) for t, s, r, i, d, a, v, x in rows]
    rows = [(t, s, r, i, d, a, v, x) for t, s, d, r, i, a, v, x in rows]
    rows += rows[:30]
    df = spark.createDataFrame(rows, REPORTS)
    changes = panes.pane_changes(panes.revisions(df, panes.week_pane))
    got = {tuple(r) for r in panes.late_cases(changes).collect()}

    want, totals = set(), {}
    by_report = {}
    seen = {tuple(r): None for r in df.select("report_id", "row_id", "symbol", "event_day", F.unix_micros("arrival").alias("a"), "value").collect()}
    for r, i, s, d, a, v in seen:
        if r is None or d is None or a is None:
            continue
        v = None if v is None or v != v else v
        if (datetime.fromtimestamp(a / 1e6, UTC).replace(tzinfo=None).date() - d).days <= 21:
            by_report.setdefault(r, []).append((a, i, s, d, v))
    for r, xs in by_report.items():
        xs.sort(key=lambda x: x[:2])
        prev, first = None, True
        for a, i, s, d, v in xs:
            start = date.fromordinal(d.toordinal() - d.weekday())
            end = (start.toordinal() + 7 - date(1970, 1, 1).toordinal() + 4) * 86400_000000
            if a >= end and (first or v != prev):
                want.add(("t", s, start.isoformat(), r))
            totals[s, start] = totals.get((s, start), 0.0) + (v or 0.0) - (0.0 if first else prev or 0.0)
            prev, first = v, False
    assert got == want
    last = panes.emissions(changes).groupBy("symbol", "window_start").agg(F.max_by("total", "version").alias("t")).collect()
    assert {(r[0], r[1]): round(r[2], 6) for r in last} == {k: round(v, 6) for k, v in totals.items()}
    assert panes.revisions(df.where("false"), panes.month_pane).count() == 0


def test_a_late_row_recomposes_only_the_windows_that_cover_its_pane(spark):
    day = lambda n: date.fromordinal(date(2026, 3, 2).toordinal() + n)
    at = lambda n: datetime(2026, 3, 2) .fromordinal(day(n).toordinal())
    rows = [("t", "A", w, w, day(7 * w), at(7 * w + 1), 10.0, "x") for w in range(6)]
    before = {tuple(r) for r in panes.emissions(panes.pane_changes(panes.revisions(spark.createDataFrame(rows, REPORTS), panes.week_pane)), 3, 7).drop("changes").collect()}
    late = [*rows, ("t", "A", 2, 99, day(14), at(14 + 20), 15.0, "x"), ("t", "A", 3, 98, day(21), at(21 + 22), 1e9, "x"), ("t", "A", 4, 97, None, at(40), 1e9, "x")]
    df = spark.createDataFrame(late, REPORTS)
    after = {tuple(r) for r in panes.emissions(panes.pane_changes(panes.revisions(df, panes.week_pane)), 3, 7).drop("changes").collect()}
    # The window from week 2 is not yet published on day 34 and takes the change into its first result; those from weeks 0 and 1 go out again
    assert {r[2:] for r in after - before} == {(day(0), day(34), 35.0, 1, True), (day(7), day(34), 35.0, 1, True), (day(14), date(1970, 1, 1), 35.0, 0, False)}
    assert {r[2:] for r in before - after} == {(day(14), date(1970, 1, 1), 30.0, 0, False)}
    assert {(r.reason, r.n_rows) for r in panes.left_out(df).collect()} == {("too late", 1), ("unreadable", 1)}


def test_a_report_that_moves_leaves_its_pane(spark):
    rows = [("t", "A", 1, 1, date(2026, 3, 3), datetime(2026, 3, 4), 5.0, "x"), ("t", "A", 1, 2, date(2026, 3, 11), datetime(2026, 3, 12), 6.0, "x")]
    out = panes.emissions(panes.pane_changes(panes.revisions(spark.createDataFrame(rows, REPORTS), panes.week_pane)))
    assert {(r.window_start, r.total) for r in out.collect()} == {(date(2026, 3, 2), 0.0), (date(2026, 3, 9), 6.0)}


def test_history_versions(spark):
    rows = [
        ("A", "d1", 1, 1, "Real Estate", None, 10.0), ("A", "d2", 2, 2, " real_estate ", "N/A", 10.0 + 1e-9), ("A", "d3", 3, 3, "-", "Trusts", NAN), ("A", "d4", 4, 4, "Energy", None, 10.0), ("A", "d4", 5, 9, "Real Estate", None, 12.0), ("A", "d4", 6, 9, "Tech", None, 12.0),
        ("B", "d2", 7, 1, None, "", None), ("B", "d3", 8, 1, None, None, 3.0), ("B", "d3", 8, 1, None, None, 3.0), (None, "d1", 9, 1, "x", "y", 1.0), ("C", None, 9, 1, "x", "y", 1.0),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "symbol string, trading_date string, row_id long, at long, sector string, industry string, n double, v string")
    got = {tuple(r) for r in history.versions(df, ["sector", "industry"], ["n"]).select("symbol", "valid_from", "valid_to").collect()}
    assert got == {("A", "d1", "d3"), ("A", "d3", "d4"), ("A", "d4", "9999-12-31"), ("B", "d2", "d3"), ("B", "d3", "9999-12-31")}
    assert history.versions(df.where("false"), ["sector"], ["n"]).count() == 0


def test_p6_found_cuts_hot_symbols_into_shards(spark):
    events, versions = changes.profile_timeline(spark, "/root/testdata/sf0.1")
    cells = asof_join.shard_map(events.where("entity is not null and t is not null"), versions.where("t is not null"))[1]
    assert cells.groupBy("entity").agg(F.count_distinct("shard").alias("n")).agg(F.max("n")).first()[0] > 1


def test_asof_join_with_shards_equals_brute_force(spark):
    rng = random.Random(9)
    ev = [(rng.choice(["hot"] * 5 + ["b", None]), rng.choice([None, *range(0, 1000)]), i) for i in range(800)]
    ve = [(rng.choice(["hot"] * 5 + ["b"]), rng.choice([None, *range(0, 1000, 3)]), rng.randint(0, 4), i) for i in range(300)]
    events = spark.createDataFrame([(*e, 0, 0) for e in ev], "entity string, t long, event_id long, shard int, best int")
    versions = spark.createDataFrame(ve, "entity string, t long, a int, rid long").select("entity", "t", F.struct("a", F.col("t").alias("at"), (-F.col("rid")).alias("rid")).alias("rank"), F.lit(1).alias("bounds"))
    want = {}
    for e, t, i in ev:
        c = [(a, vt, -r) for v, vt, a, r in ve if v == e and vt is not None and t is not None and vt <= t]
        if e is not None and c:
            want[i] = max(c)
    hot, cells = asof_join.shard_map(events.where("entity is not null and t is not null"), versions.where("t is not null"), 2)
    per_shard = cells.where("entity = 'hot'").select("shard").distinct().count()
    assert hot.where("entity = 'hot'").count() == 1 and per_shard > 200  # no cap on an entity's shards
    for shard_rows in (2, 40, 10**6):
        got = {r.event_id: tuple(r.best) for r in asof_join.as_known(events, versions, shard_rows=shard_rows).collect()}
        assert got == want
    assert asof_join.as_known(events.where("false"), versions).count() == 0
    assert asof_join.as_known(events, versions.where("false")).count() == 0


def _quality_rows(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = []
    for d in range(5):
        for i in range(n):
            a, b = rng.gauss(50, 10), rng.gauss(5, 1)
            if d == 2:
                a = None if i % 3 == 0 else a
            if d == 3:
                a = a * 100
            if d == 4:
                b = 5.0 if i % 2 else b
            rows.append((i + 1000 * d, f"d{d}", a, b, rng.gauss(20, 1), "x"))
    return spark.createDataFrame(rows, "row_id long, trading_date string, a double, b double, c double, num string")


def test_quality_finds_damaged_loads(spark):
    df = _quality_rows(spark)
    base = quality.base_profile(quality.value_counts(df, "t", ["a", "b", "c", "num"]))
    drift = quality.drift({"t": (df, ["a", "b", "c"])})
    cand = {(r.load, r.column_name) for r in drift.where("candidate").collect()}
    assert {("d2", "a"), ("d3", "a"), ("d4", "a"), ("d4", "b")} <= cand
    auc = {(r.load, r.column_name): r.only_auc for r in drift.collect()}
    assert auc["d3", "a"] > 0.8 and auc["d1", "c"] < 0.6
    got = {(r.column_name, r.load, r.issue) for r in quality.load_issues(base, drift, [("t", "a"), ("t", "b"), ("t", "c")]).collect()}
    assert got == {("a", "d2", "nulls"), ("a", "d3", "level"), ("a", "d4", "level"), ("b", "d4", "heaping")}


def test_quality_base_is_exact(spark):
    df = _quality_rows(spark, 4, 101).unionByName(spark.createDataFrame([(1, "d0", NAN, INF, None, None), (2, "d9", None, None, None, " ")], "row_id long, trading_date string, a double, b double, c double, num string"))
    got = {(r.load, r.column_name): r for r in quality.base_profile(quality.value_counts(df, "t", ["a", "b", "c", "num"])).collect()}
    pdf = df.toPandas()
    for (load, c), r in got.items():
        g = pdf[pdf.trading_date == load]
        if c == "num":
            assert r.n_missing == int(g[c].isna().sum() + (g[c].str.strip() == "").sum())
            continue
        v = g[c].dropna()
        f = v[np.isfinite(v)]
        assert (r.n_rows, r.n_missing, r.n_distinct, r.mode_count) == (len(g), len(g) - len(v), v.nunique(), int(v.round(6).value_counts().max()) if len(v) else 0)
        assert (r.median is None and not len(f)) or abs(r.median - f.median()) < 1e-9


def test_quality_of_nothing(spark):
    df = _quality_rows(spark, 2, 5).where("false")
    assert quality.base_profile(quality.value_counts(df, "t", ["a", "num"])).count() == 0
    assert quality.drift({"t": (df, ["a", "b"])}).count() == 0


def test_cases_of_the_sql_are_candidates(spark):
    d = "/root/testdata/sf0.1"
    want = {r[2] for r in connect(d).execute(changes.SQL["p3_found"]).fetchall() if r[0] == "profile" and r[3] != "range"}
    drift = quality.drift({"profile": changes._watched_tables(spark, d)["profile"]}).where("column_name = 'shortPercentOfFloat'").collect()
    assert want and want <= {r.load for r in drift if r.candidate}
    assert all(r.only_auc > 0.65 for r in drift if r.load in want)


def test_issues_do_not_depend_on_other_loads(spark):
    rng = random.Random(5)
    rows = []
    for d in range(24):
        for i in range(600):
            v, w = rng.gauss(50, 10), rng.gauss(5, 1)
            a, b = v * (100 if d == 22 else 500 if d == 23 else 1), w * (100 if d >= 22 else 1)
            # c's median crosses the gap between its two values by few rows
            rows.append((i + 1000 * d, f"d{d:02}", a, 700.0 if d == 23 and i % 5 < 2 else b, float("inf") if d == 23 and i % 5 < 2 else w, 1.0 if i < (299 if d == 23 else 301) else 10.0))
    df = spark.createDataFrame(rows, "row_id long, trading_date string, a double, b double, e double, c double")
    found = []
    for part in (df, df.where("trading_date >= 'd22'")):
        cols = ["a", "b", "e", "c"]
        base = quality.base_profile(quality.value_counts(part, "t", cols))
        found.append({(r.column_name, r.load, r.issue) for r in quality.load_issues(base, quality.drift({"t": (part, cols)}), [("t", c) for c in cols]).collect() if r.load == "d23"})
    assert found[0] == found[1] == {("a", "d23", "level"), ("b", "d23", "heaping"), ("e", "d23", "heaping"), ("c", "d23", "level")}


def test_profile_covers_every_table_and_text(spark):
    d = "/root/testdata/sf0.001"
    got = changes.p3_profile(spark, d).toPandas()
    assert set(got.table_name) == set(changes.PROFILED) >= {"finra_short_volume", "cftc_tff_positioning"}
    n = {t: connect(d).execute(f"SELECT count(*) FROM {t}").fetchone()[0] for t in ("finra_short_volume", "cftc_tff_positioning")}
    assert got[got.column_name == "source_date"].groupby("table_name").n_rows.sum().to_dict() == n
    grade = got[got.column_name == "GradeDate"]
    bad = changes.table(spark, d, "upgrades_downgrades").where(changes.data_rows() & F.col("GradeDate").rlike("[A-Za-z]{3}")).count()
    assert grade.violations.sum() >= bad and grade.first_text.notna().all()
    assert got[(got.table_name == "estimates") & (got.column_name == "avg")].violations.isna().all()
    texts = got[got.first_text.notna() & ~got.column_name.isin(["no_analyst_coverage"])]
    assert texts.violations.notna().all()
