"""Matching, dedupe, packing, mixing and languages on small frames, with the odd cases their docstrings define."""

import random
from datetime import date

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import DATA
from tidemark.llm import canon, dedupe, fingerprints, langid, mixing, packing, queries, tokens


def osa(a: str, b: str) -> int:
    """Optimal string alignment distance by the full table."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=8, unique=True), st.text("abc", min_size=1, max_size=14))
def test_automaton_equals_full_table(names, value):
    trie = canon.Trie((i + 1, n, None) for i, n in enumerate(names))
    got = {(d, i) for d, _, i in trie.search(value)}
    want = {(osa(value, n), i + 1) for i, n in enumerate(names) if osa(value, n) <= canon.allowed(min(len(value), len(n)))}
    assert got == want


FIRMS = [(1, "Aldermoor & Co", None), (2, "Aldermoor Investment Bank", None), (3, "Brackwell Research", "BCLR"), (4, "Oakhampden Equity Advisers", None), (5, "Ulvershaw Group", None)]


@pytest.mark.parametrize(
    ("value", "ref"),
    [
        ("ALDERMOOR & CO", 1), ("Aldermoor and Co", 1), ("Aldermoor Inv. Bank", 2), ("Aldermoor", None), ("BCLR", 3), ("Brackwell", 3), ("Brackwell Rsch", 3), ("The Oákhampden Equity Advisers (US)", 4), ("OAKHMPDEN Eq. Advisers", 4),
        ("OakhampdenEquityAdvisers", 4), ("Ulversa wGroup", 5), ("Ulvershaw Group - NY desk", 5), ("Ulvershaw Group, LLC", 5), ("Nimbus Factor Lab", None), ("???", None), ("x" * 50_000, None), ("(US)", None),
    ],
)
def test_names(value, ref):
    hit = canon.Trie(FIRMS).best(value)
    assert (hit[2] if hit else None) == ref


def _firms(spark, rows=FIRMS, most=canon.MAX_LIST):
    return canon.read_list(spark.createDataFrame(rows, "firm_id long, firm_name string, code string"), "firm_id", "firm_name", "code", most=most)


@pytest.mark.parametrize("most", [canon.MAX_LIST, 0])
def test_match_in_spark(spark, most):
    """The list travels, or stays a table in shards."""
    rows = [(1, "Ulvershaw Group", "x"), (2, "ulvershaw group", "x"), (2, "ulvershaw group", "x"), (3, None, "x"), (4, "  ", "x"), (5, "nobody at all", "x"), (None, "BCLR", "x"), (6, "Aldermoor", "x")]
    df = spark.createDataFrame(rows, "row_id long, Firm string, ref_id string")
    lists = {"f": _firms(spark, most=most)}
    got = sorted((tuple(r) for r in canon.match(df, {"Firm": "f"}, lists).drop("value").collect()), key=str)
    assert got == sorted([(2, "Firm", 5), (2, "Firm", 5), (5, "Firm", 0), (None, "Firm", 3), (6, "Firm", 0)], key=str)
    ids = sorted(((r.row_id, r.Firm_id) for r in canon.with_ids(df, {"Firm": "f"}, lists).collect()), key=str)
    assert ids == sorted([(1, 5), (2, 5), (2, 5), (3, 0), (4, 0), (5, 0), (None, 3), (6, 0)], key=str)
    assert canon.match(df.where("false"), {"Firm": "f"}, lists).count() == 0
    assert {r.ref_id for r in canon.match(df, {"Firm": "f"}, {"f": _firms(spark, [], most)}).collect()} == {0}


def test_a_list_of_25000_gives_the_same_either_way(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(3, 9)))
    tails = ["Group", "Equity Research", "Capital Markets", "& Co", "Bank", "Partners", "", "Securities"]
    names = [(i, f"{word()} {word() if rng.random() < 0.5 else ''} {rng.choice(tails)}".strip(), "".join(rng.choices("ABCDEFGHIJ", k=4)) if rng.random() < 0.3 else None) for i in range(1, 25_001)]
    values = []
    for _, n, c in rng.sample(names, 400):
        cut = rng.randrange(len(n))
        values += [n, n.upper(), n[:cut] + n[cut + 1 :], n[:cut] + rng.choice("xyz") + n[cut:], canon.head(n), c, f"The {n} (US)", n.replace("Research", "rsch")]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    big = _firms(spark, names)
    assert big.entries is None
    got = {r.value: r.ref_id for r in canon.match_sharded(df, big, shard_aliases=3000, salt_values=500).collect()}
    trie = canon.Trie(names)
    want = {v: (hit[2] if (hit := trie.best(v)) else 0) for v in values if v and v.strip()}
    assert got == want


def test_words_are_a_parameter_and_too_many_spellings_are_refused(spark):
    words = canon.Words(abbreviations={"gesellschaft": ("ges",)}, endings=frozenset(), article=r"^die\s+")
    assert canon.Trie([(1, "Gesellschaft Nord", None)], words).best("die Ges. Nord") == (0, 1, 1)
    with pytest.raises(ValueError, match="spellings"):
        canon.Trie([(1, "capital group " * 8, None)])


def leaders(rows, minutes=10):
    """Brute force: in order of arrival every row meets all first rows."""
    reps, out = [], set()
    for rid, b, akey, day, t, clock, fg in sorted((r for r in rows if None not in (r[0], r[2], r[3], r[4])), key=lambda r: r[0]):
        hit = [x for x in reps if x[1] == akey and (x[5] is None or fg is None or x[5] == fg) and (abs(x[3] - t) <= minutes * 60_000_000 if x[4] and clock else x[2] == day)]
        if hit:
            out.add((hit[0][0], rid))
        else:
            reps.append((rid, akey, day, t, clock, fg))
    return out


def _actions(n, batches, seed=11):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        d = rng.randint(0, 3)
        clock = rng.random() < 0.7
        second = rng.choice([0, 30, 299, 600, 601, 40_000, 86_000, 86_399, 85_800, 85_799]) if clock else 0
        t = (d * 86_400 + second) * 1_000_000
        rows.append((i + 1, f"b{i * batches // n}", rng.choice(["A|x", "B|" + "y" * 400, None, ""]) if rng.random() < 0.9 else "hot", date.fromordinal(date(1970, 1, 1).toordinal() + d) if rng.random() < 0.97 else None, t, clock, rng.choice([None, "buy", "sell"])))
    return rows


ACTIONS = "row_id long, b string, akey string, day date, t long, clock boolean, fg string, rep string"


def test_dedupe_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "SALT_ROWS", 50)
    rows = _actions(500, 3)
    df = spark.createDataFrame([(*r, "clash") for r in rows], ACTIONS)
    got = [tuple(r) for r in dedupe.dedupe_batches(df, "b", ["b0", "b1", "b2"]).collect()]
    assert len(got) == len(set(got))
    assert set(got) == leaders(rows)


def test_sixty_batches_in_a_store_that_stays(spark, monkeypatch, tmp_path):
    """Runs are merged over several levels, and a second call goes on where the first ended."""
    monkeypatch.setattr(dedupe, "FAN", 3)
    rows = _actions(480, 60, seed=4)
    df = spark.createDataFrame([(*r, "clash") for r in rows], ACTIONS)
    names, path = [f"b{k}" for k in range(60)], str(tmp_path / "store")
    got = {tuple(r) for part in (names[:25], names[25:]) for r in dedupe.dedupe_batches(df, "b", part, store_path=path, buckets=2).collect()}
    assert got == leaders(rows)
    store = fingerprints.Store(path)
    assert store.batches == 60 and len(store.runs) <= 8
    assert {p.name for p in (tmp_path / "store").iterdir() if p.is_dir()} <= set(store.runs)  # a run without new contents has no files


def test_an_interrupted_batch_is_taken_up_again(spark, monkeypatch, tmp_path):
    rows = [(1, "a", "A|x", date(1970, 1, 1), 0, True, None), (2, "b", "A|x", date(1970, 1, 1), 1_000_000, True, None)]
    df, path = spark.createDataFrame(rows, ACTIONS.rsplit(",", 1)[0]), str(tmp_path / "store")
    commit = fingerprints.Store.commit
    with monkeypatch.context() as m:
        m.setattr(fingerprints.Store, "commit", lambda self, runs, batches: commit(self, runs, batches) if batches == 0 else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            dedupe.dedupe_batches(df, "b", ["a"], store_path=path)
    assert fingerprints.Store(path).batches == 0
    assert dedupe.dedupe_batches(df, "b", ["a"], store_path=path).count() == 0
    assert [tuple(r) for r in dedupe.dedupe_batches(df, "b", ["b"], store_path=path).collect()] == [(1, 2)]


def test_near_duplicates_are_found_by_coverage(spark):
    """One character changed, a paragraph put in front, half of the text only, another day, another text."""
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(120))
    old, day = text(), date(1970, 1, 2)
    changed = old[:300] + "#" + old[301:]
    rows = [(1, "a", old, day), (2, "a", text(), day), (3, "b", changed, day), (4, "b", old[:250], day), (5, "b", old[:200] + text(), day), (6, "b", changed, date(1970, 1, 3)), (7, "b", text(), day), (8, "b", old, day)]
    df = spark.createDataFrame([(*r, 86_400_000_000, False, None) for r in rows], "row_id long, b string, akey string, day date, t long, clock boolean, fg string")
    near = {r.row_id_b: (r.row_id_a, r.coverage) for r in dedupe.dedupe_batches(df, "b", ["a", "b"], near=True).collect()}
    assert {k: v[0] for k, v in near.items()} == {3: 1, 4: 1} and 0.8 <= near[3][1] < 1 and near[4][1] == 1
    assert {tuple(r) for r in dedupe.dedupe_batches(df, "b", ["a", "b"]).collect()} == {(1, 8)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=40), st.integers(-3, 3)), max_size=8))
def test_fingerprints_are_the_least_hashes_of_all_windows(contents):
    blocks = np.array([b for _, b in contents], dtype=np.int64)
    fps, sizes = fingerprints.fingerprints([t for t, _ in contents], blocks)
    at = np.cumsum(sizes) - sizes
    for (text, block), a, n in zip(contents, at, sizes, strict=True):
        own = fps[a : a + n]
        padded = text.ljust(fingerprints.GRAM, "\0")
        gram = [fingerprints.fingerprints([padded[i : i + fingerprints.GRAM]], np.array([block]))[0].view(np.uint64)[0] for i in range(len(padded) - fingerprints.GRAM + 1)]
        want = {min(gram[i : i + fingerprints.WINDOW]) for i in range(max(1, len(gram) - fingerprints.WINDOW + 1))}
        assert set(own.view(np.uint64)) == want and len(own) == len(want)


def test_a_batch_with_strange_names(spark):
    rows = [(1, "", "A", date(1970, 1, 1), 0, True, None), (2, None, "A", date(1970, 1, 1), 1, True, None), (3, "c/ d=", "A", date(1970, 1, 1), 2, True, None), (4, "unlisted", "A", date(1970, 1, 1), 3, True, None)]
    df = spark.createDataFrame(rows, ACTIONS.rsplit(",", 1)[0])
    assert {tuple(r) for r in dedupe.dedupe_batches(df, "b", ["", None, "c/ d="]).collect()} == {(1, 2), (1, 3)}


def test_dedupe_of_nothing(spark):
    df = spark.createDataFrame([], "row_id long, b string, akey string, day date, t long, clock boolean, fg string")
    assert dedupe.dedupe_batches(df, "b", ["b0", "b1"]).count() == 0
    assert dedupe.dedupe_batches(df, "b", []).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=12), st.integers(0, 60))
def test_fullest_equals_all_subsets(items, room):
    sums = {0}
    for n in items:
        sums |= {s + n for s in sums}
    count = {n: items.count(n) for n in items}
    got = packing.fullest(sorted(count), dict(count), room, random.Random(1))
    assert sum(got) == max(s for s in sums if s <= room)
    assert all(got.count(n) <= count[n] for n in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=200), st.integers(100, 160))
def test_pack_never_overfills(sizes, capacity):
    bins = packing.pack(sizes, capacity)
    load: dict[int, int] = {}
    for b, n in zip(bins, sizes, strict=True):
        load[b] = load.get(b, 0) + n
    assert all(v <= capacity for v in load.values())
    assert len({b for b, n in zip(bins, sizes, strict=True) if n}) <= 2 * max(1, sum(sizes) / capacity) + 1


def test_pack_items_in_spark(spark):
    rows = [(i, n, "x") for i, n in enumerate([0, None, -5, 10, 10, 10, 25, 99, 100, 101, 250, 1000])] + [(None, 5, "x"), (3, 10, "x")]
    items = spark.createDataFrame(rows, "doc_id long, n_tokens long, capacity string")
    out = packing.pack_items(items, [("a", 100), ("b", 30), (None, 5), ("z", 0)], shard_items=3).collect()
    for run, cap in (("a", 100), ("b", 30)):
        got = [r for r in out if r.run_name == run]
        load, size = {}, {}
        for r in got:
            load[r.container_id] = load.get(r.container_id, 0) + r.piece_size
            size[r.doc_id] = size.get(r.doc_id, 0) + r.piece_size
            assert r.piece_start == r.piece_no * cap
        assert max(load.values()) <= cap
        assert size == {i: max(n or 0, 0) * (2 if i == 3 else 1) for i, n, _ in rows if i is not None}
        assert not [r for r in got if r.piece_no and max(dict((a, b or 0) for a, b, _ in rows)[r.doc_id], 0) <= cap]
    assert packing.pack_items(items.where("false"), [("a", 100)]).count() == 0
    assert packing.pack_items(items, []).count() == 0


def _mix_frames(spark, n=3000):
    rng = random.Random(2)
    names = ["wiki", "WIKI", "Wi-ki ", "web", "rare", None, "", "other"]
    rows = [(i, rng.choices(names, [30, 2, 2, 20, 1, 1, 1, 3])[0], rng.choice([0, 1, 5, 9, 40, None]), "x") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, key string")
    targets = spark.createDataFrame([("wiki", 0.5, 1), ("web", 0.3, 2), ("rare", 0.2, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeats long")
    return rows, docs, targets


def test_mix_reaches_shares_within_caps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 100)
    rows, docs, targets = _mix_frames(spark)
    drawn, report = mixing.mix(docs, targets)
    rep = {r.source: r for r in report.collect()}
    have = {"wiki": sum(r[2] or 0 for r in rows if r[1] and r[1].lower().replace("-", "").strip() == "wiki"), "rare": sum(r[2] or 0 for r in rows if r[1] == "rare")}
    assert rep["rare"].tokens_at_hand == have["rare"] and rep["wiki"].tokens_at_hand == have["wiki"]
    for s, r in rep.items():
        assert r.most_repeats <= r.max_repeats
        assert abs(r.tokens - r.budget) <= 40 if s != "absent" else r.tokens == 0
    times = drawn.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.count_distinct("epoch").alias("e"), F.max("epoch").alias("m")).collect()
    assert all(r.n == r.e == r.m <= rep[r.source].max_repeats for r in times)
    spread = [r.n for r in times if r.source == "rare"]
    assert max(spread) - min(spread) <= 1
    again = mixing.mix(docs.repartition(7), targets)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, drawn.collect()))


def test_mix_with_a_total_and_with_nothing(spark):
    _, docs, targets = _mix_frames(spark, 500)
    rep = {r.source: r for r in mixing.mix(docs, targets, total=200)[1].collect()}
    assert rep["wiki"].budget == 100 and abs(rep["wiki"].tokens - 100) <= 40
    drawn, report = mixing.mix(docs.where("false"), targets)
    assert drawn.count() == 0 and report.count() == 4


SENTENCES = {
    "en": ["The old harbour was rebuilt after the fire and it still stands.", "Visitors can see what is left of it during the summer months."],
    "de": ["Der alte Hafen wurde nach dem Brand wieder aufgebaut und steht noch.", "In den Sommermonaten können Besucher die Überreste besichtigen."],
    "ru": ["Старая гавань была восстановлена после пожара и стоит до сих пор.", "Летом посетители могут увидеть то, что от неё осталось."],
}


def _languages(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, label string, departs string")
    codes = spark.createDataFrame([("de", "deu", "German", "Deutsch"), ("en", "eng", "English", "English"), ("ru", "rus", "Russian", "русский")], "lang_code string, code3 string, english_name string, native_name string")
    docs, names = langid.label_index(docs, codes)
    return {(r.doc_id, r.seg_no): (r.lang_code, r.departs, r.confidence) for r in langid.languages(docs, langid.fit(docs, names), names).collect()}


def test_languages(spark):
    rows = [(100 + i, "\n\n".join(SENTENCES[lang] * 4), lang, "x", "x") for i, lang in enumerate(["en", "de", "ru"] * 10)]
    en, de, ru = (" ".join(SENTENCES[x]) for x in ("en", "de", "ru"))
    rows += [
        (1, en, "en_GB", None, None), (2, de, "en", None, None), (3, de, "Deutsch ", None, None), (4, ru, None, None, None), (5, ru, "??", None, None), (6, None, "en", None, None), (7, "", "en", None, None), (8, "#REDIRECT [[Hafen]]", "de", None, None),
        (9, f"{{{{Infobox|a=1}}}}\n\n{en} {en}\n\n \n\n== Geschichte ==\n\n{de}", "en", None, None), (10, (en + "\n\n") * 4000 + ru, "eng", None, None), (11, "asdf qwer hjkl", "en", None, None), (12, "{| class=x\n! Der alte Hafen steht.\n|}", "en", None, None), (None, de, "de", None, None),
    ]
    got = _languages(spark, rows)
    small = {k: v[:2] for k, v in got.items() if k[0] is None or k[0] < 100}
    assert small == {
        (1, -1): ("en", False), (2, -1): ("de", True), (3, -1): ("de", False), (4, -1): ("ru", True), (5, -1): ("ru", True), (6, -1): (None, False), (7, -1): (None, False), (8, -1): (None, False), (9, -1): ("en", False), (9, 3): ("de", True),
        (10, -1): ("en", False), (10, 4000): ("ru", True), (11, -1): (None, False), (12, -1): (None, False), (None, -1): ("de", False),
    }
    assert all(0 <= v[2] <= 1 for v in got.values()) and got[9, 3][2] > 0.8


def test_languages_without_labels_or_rows(spark):
    assert _languages(spark, [(1, SENTENCES["en"][0], None, None, None)]) == {(1, -1): (None, False, 0.0)}
    assert _languages(spark, []) == {}


def test_held_out_accuracy(spark):
    """Labels that name a language are right for nine in ten documents at least, and the model never saw most of them."""
    docs, codes = langid.label_index(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/lang_codes.parquet"))
    model = langid.fit(docs, codes, sample_docs=15)
    got = langid.languages(docs, model, codes).where("seg_no = -1 and lang_code is not null").join(docs.where("label is not null").select("doc_id", "label"), "doc_id").toPandas()
    assert (got.lang_code == got.label.map(dict(enumerate(codes)))).mean() > 0.9


def test_tokens_are_whole_texts(spark):
    texts = ["", None, "hello world", "<|endoftext|>", "один два", "word " * 50_000]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r.n_tokens for r in tokens.with_token_counts(df).collect()}
    enc = tokens.encoder(tokens.default_vocabulary())
    assert got == {i: len(enc.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


def test_more_capacities_than_allowed_are_refused(spark, tmp_path):
    import pytest

    from tidemark.llm import queries

    spark.range(1001).selectExpr("concat('r', id) AS run_name", "id + 100 AS capacity_tokens").write.parquet(f"{tmp_path}/pack_capacities.parquet")
    spark.createDataFrame([(1, "s", "text")], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    with pytest.raises(ValueError, match="1000"):
        queries.p8_packed(spark, str(tmp_path))
