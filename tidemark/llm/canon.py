"""Mapping free-entered values to a canonical list: a trie of reference entries searched with a Levenshtein automaton.

Every entry enters the trie by its name and by alias paths: its code, its name with customary abbreviations, its head alone where
no other entry has the same head (a head that several share names none of them). Values and aliases are reduced to letters and digits, so that case, blanks, accents and
punctuation don't count, and decorations (a leading article, company forms, brackets, desks, "rating") are taken off; which words these are
is a parameter (`Words`). The automaton, a bit-parallel one with transpositions, walks the trie and returns all entries within a distance that depends on the length. The
nearest wins, among equals the one whose alias is a full name, then the smallest id; a value with no entry within reach gets 0.

Values are matched where they are read: each Python worker looks up the distinct values of a batch once and remembers them, so that
nothing is shuffled and a value that a third of all rows hold costs no more than a rare one. The list travels with the job only
while it has at most MAX_LIST entries; a longer one stays a table, cut into shards by length of alias, and distinct values meet the
shards whose lengths are within their distance (`match_sharded`). Both ways give the same results.

Edge cases: null and blank values give no row; very long values are compared whole; an empty list gives 0 for every value; an empty
table gives no rows; repeated rows give repeated results; an entry with more than MOST_FORMS spellings is refused.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MAX_LIST, CACHE, MOST_FORMS = 20_000, 200_000, 4096
#: Priority that marks a head which several entries share.
SHARED = 9


@dataclass(frozen=True)
class Words:
    """What a kind of names is abbreviated by, decorated with and ends in; the defaults suit firms and grades."""

    abbreviations: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "and": ("",), "brokerage": ("brkg",), "capital": ("cap",), "equal": ("eq",), "equity": ("eq",), "group": ("grp",), "investment": ("inv",), "market": ("mkt",), "markets": ("mkts",),
            "partners": ("ptnrs",), "research": ("rsch",), "sector": ("sect",), "securities": ("sec",),
        }
    )
    #: Descriptive last words besides the abbreviated ones
    endings: frozenset[str] = frozenset({"co", "bank", "advisers", "company", "&"})
    decoration: str = r"\s*(\([^()]*\)|\s-\s.*desk|,?\s*\b(inc|ltd|llc|plc|corp)\.?|\brating|[*.])\s*$"
    article: str = r"^\s*the\s+"


WORDS = Words()


def allowed(length: int) -> int:
    """Edits within reach of a reduced value of this length."""
    return 0 if length <= 4 else 1 if length <= 7 else 2 if length <= 11 else 3


def reduced(value: str) -> str:
    """Letters and digits only, lower case, no accents, '&' written out."""
    text = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    return re.sub(r"[\W_]+", "", text.replace("&", " and ").lower())


def undecorated(value: str, words: Words = WORDS) -> str:
    """A value without what is put around names."""
    out = re.sub(words.article, "", value, flags=re.I)
    while (cut := re.sub(words.decoration, "", out, flags=re.I)) != out and cut.strip():
        out = cut
    return out


def aliases(name: str, code: str | None = None, words: Words = WORDS) -> dict[str, int]:
    """Reduced alias -> 0 for the full name, 1 for others."""
    forms = [""]
    for w in re.sub(r"&", " and ", name).lower().split():
        forms = [f + x for f in forms for x in (w, *words.abbreviations.get(reduced(w), ()))]
        if len(forms) > MOST_FORMS:
            raise ValueError(f"{name[:80]!r} has more than {MOST_FORMS} spellings")
    out = {reduced(f): 1 for f in forms}
    if code and code.strip():
        out[reduced(code)] = 1
    out[reduced(name)] = 0
    return {a: p for a, p in out.items() if a}


def head(name: str, words: Words = WORDS) -> str:
    """A name without its descriptive last words."""
    parts = name.split()
    while len(parts) > 1 and (parts[-1].lower() in words.abbreviations or parts[-1].lower() in words.endings):
        parts.pop()
    return reduced(" ".join(parts))


def forms_of(value: str, words: Words = WORDS) -> list[str]:
    """What a value is searched by: without decorations, then whole."""
    return [v for v in dict.fromkeys((reduced(undecorated(value, words)), reduced(value)))]


class Trie:
    """Aliases as nested dicts; under '' a node has its entries as (priority, id)."""

    def __init__(self, entries: Iterable[tuple[int, str, str | None]] = (), words: Words = WORDS):
        self.root: dict = {}
        self.exact: dict[str, list[tuple[int, int]]] = {}
        self.shared: set[str] = set()
        self.words = words
        entries = [(int(i), n, c) for i, n, c in entries if n and n.strip()]
        heads: dict[str, set[int]] = {}
        for i, n, c in entries:
            heads.setdefault(head(n, words), set()).add(i)
            for a, p in aliases(n, c, words).items():
                self.add(a, p, i)
        for h, ids in heads.items():
            if len(ids) > 1:
                self.shared.add(h)
            elif len(h) > 4:
                self.add(h, 1, *ids)

    def add(self, alias: str, priority: int, i: int) -> None:
        node = self.root
        for ch in alias:
            node = node.setdefault(ch, {})
        node.setdefault("", []).append((priority, i))
        self.exact.setdefault(alias, []).append((priority, i))

    def search(self, value: str) -> list[tuple[int, int, int]]:
        """(distance, priority, id) of all entries within the distance that the shorter of value and alias allows."""
        m = len(value)
        k = allowed(m)
        mask: dict[str, int] = {}
        for i, ch in enumerate(value):
            mask[ch] = mask.get(ch, 0) | 1 << (i + 1)
        full, end = (1 << (m + 1)) - 1, 1 << m
        start = [(1 << (d + 1)) - 1 & full for d in range(k + 1)]
        found, stack = [], [(self.root, 0, start, None, "")]
        while stack:
            node, depth, now, before, came = stack.pop()
            for ch, child in node.items():
                if not ch:
                    for d in range(min(k, allowed(min(m, depth))) + 1):
                        if now[d] & end:
                            found.extend((d, p, i) for p, i in child)
                            break
                    continue
                here = mask.get(ch, 0)
                nxt = [(now[0] << 1) & here]
                for d in range(1, k + 1):
                    r = (now[d] << 1) & here | now[d - 1] | now[d - 1] << 1 | nxt[d - 1] << 1
                    if before is not None:
                        r |= ((before[d - 1] << 1) & here) << 1 & mask.get(came, 0)
                    nxt.append(r & full)
                if nxt[k]:
                    stack.append((child, depth + 1, nxt, now, ch))
        return found

    def best(self, value: str) -> tuple[int, int, int] | None:
        """(distance, priority, id) of the nearest entry."""
        tries = forms_of(value, self.words)
        for v in tries:
            if v in self.exact:
                p, i = min(self.exact[v])
                return 0, p, i
            if v in self.shared:
                return None
        return min((x for v in tries if v for x in self.search(v)), default=None)


@dataclass
class RefList:
    """A reference list: its entries where they are few enough to travel with the job, and the table (id, name, code) in any case."""

    frame: DataFrame
    entries: list[tuple[int, str, str | None]] | None
    words: Words = WORDS


def read_list(ref: DataFrame, id_col: str, name_col: str, code_col: str | None = None, words: Words = WORDS, most: int = MAX_LIST) -> RefList:
    """The reference list. Up to `most` entries come to the driver, longer lists stay where they are."""
    frame = ref.select(F.col(id_col).cast("long").alias("id"), F.col(name_col).alias("name"), (F.col(code_col) if code_col else F.lit(None)).cast("string").alias("code")).where("id is not null and name is not null")
    got = frame.limit(most + 1).collect()
    return RefList(frame, sorted((r[0], r[1], r[2]) for r in got) if len(got) <= most else None, words)


class _Finder:
    """Remembers what values were looked up."""

    def __init__(self, lists: dict[str, tuple[list, Words]]):
        self.tries = {name: Trie(entries, words) for name, (entries, words) in lists.items()}
        self.cache: dict[tuple[str, str], int] = {}

    def ids(self, name: str, values: Iterable[str]) -> dict[str, int]:
        out = {}
        for v in values:
            if (got := self.cache.get((name, v))) is None:
                hit = self.tries[name].best(v)
                got = hit[2] if hit else 0
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[name, v] = got
            out[v] = got
        return out


def _lookup(lists: dict[str, tuple[list, Words]], fields: dict[str, str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = _Finder(lists)
        names = {name: {n for _, n, _ in entries} for name, (entries, _) in lists.items()}
        for pdf in batches:
            out = []
            for f, name in fields.items():
                values = pdf[f]
                ids = finder.ids(name, [v for v in values.dropna().unique() if v.strip() and v not in names[name]])
                at = values.isin(list(ids))
                out.append(pd.DataFrame({"row_id": pdf["row_id"][at], "field_name": f, "value": values[at], "ref_id": values[at].map(ids).astype("int64")}))
            yield pd.concat(out, ignore_index=True)

    return run


def _columns(lists: dict[str, tuple[list, Words]], fields: dict[str, str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = _Finder(lists)
        for pdf in batches:
            for f, name in fields.items():
                ids = finder.ids(name, [v for v in pdf[f].dropna().unique() if v.strip()])
                pdf[f"{f}_id"] = pdf[f].map(ids).fillna(0).astype("int64")
            yield pdf

    return run


def _split(fields: dict[str, str], lists: dict[str, RefList]) -> tuple[dict[str, str], dict[str, str], dict[str, tuple[list, Words]]]:
    """Fields whose list travels, fields whose list doesn't, and the lists that travel."""
    few = {f: n for f, n in fields.items() if lists[n].entries is not None}
    return few, {f: n for f, n in fields.items() if f not in few}, {n: (lists[n].entries, lists[n].words) for n in dict.fromkeys(few.values())}


def match(rows: DataFrame, fields: dict[str, str], lists: dict[str, RefList]) -> DataFrame:
    """(row_id, field_name, value, ref_id) for each non-blank value that isn't an entry letter for letter."""
    few, many, given = _split(fields, lists)
    kind = "row_id long, field_name string, value string, ref_id long"
    out = rows.select("row_id", *few).mapInPandas(_lookup(given, few), kind) if few else None
    for f, name in many.items():
        found = match_sharded(rows.select(F.col(f).alias("value")), lists[name])
        found = found.join(lists[name].frame.select(F.col("name").alias("value")).distinct(), "value", "left_anti")
        part = rows.select("row_id", F.lit(f).alias("field_name"), F.col(f).alias("value")).join(found, "value").select("row_id", "field_name", "value", "ref_id")
        out = part if out is None else out.unionByName(part)
    return out


def with_ids(rows: DataFrame, fields: dict[str, str], lists: dict[str, RefList]) -> DataFrame:
    """rows with a column <field>_id for each field: the entry meant, 0 if none."""
    rows = rows.drop(*[f"{f}_id" for f in fields])
    few, many, given = _split(fields, lists)
    if few:
        schema = ", ".join([*[f"`{c}` {t}" for c, t in rows.dtypes], *[f"`{f}_id` bigint" for f in few]])
        rows = rows.mapInPandas(_columns(given, few), schema)
    for f, name in many.items():
        found = match_sharded(rows.select(F.col(f).alias("value")), lists[name]).select(F.col("value").alias("__v"), F.col("ref_id").alias("__i"))
        rows = rows.join(found, rows[f] == found["__v"], "left").withColumn(f"{f}_id", F.coalesce("__i", F.lit(0).cast("long"))).drop("__v", "__i")
    return rows


def match_sharded(values: DataFrame, ref: RefList, shard_aliases: int = MAX_LIST, salt_values: int = 200_000) -> DataFrame:
    """(value, ref_id) for each distinct non-blank value and a list of any size, as Trie.best finds it.

    Aliases are cut into shards by length; a value visits the lengths within its distance, and of these every shard: the nearest of all wins.
    A task has one shard of about shard_aliases aliases and about salt_values of the distinct values at most.
    """
    words = ref.words

    def alias_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(a, len(a), p, i) for i, n, c in zip(pdf["id"], pdf["name"], pdf["code"], strict=True) if n.strip() for a, p in aliases(n, c, words).items()]
            yield pd.DataFrame(out, columns=["alias", "size", "priority", "id"])

    def head_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            heads = [(head(n, words), i) for i, n in zip(pdf["id"], pdf["name"], strict=True) if n.strip()]
            yield pd.DataFrame([(h, len(h), i) for h, i in heads], columns=["alias", "size", "id"])

    def asked_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tries = [(x, j, v) for x in pdf["value"] for j, v in enumerate(forms_of(x, words)) if v]
            reach = [(x, j, v, n) for x, j, v in tries for n in range(len(v) - allowed(len(v)), len(v) + allowed(len(v)) + 1)]
            yield pd.DataFrame(reach, columns=["value", "nth", "form", "size"])

    def run(v: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        trie = Trie(words=words)
        for a, p, i in zip(e["alias"], e["priority"], e["id"], strict=True):
            if p == SHARED:
                trie.shared.add(a)
            else:
                trie.add(a, int(p), int(i))
        out = []
        for x, j, form in zip(v["value"], v["nth"], v["form"], strict=True):
            if form in trie.exact:
                out.append((x, 2 * j, 0, *min(trie.exact[form])))
            elif form in trie.shared:
                out.append((x, 2 * j + 1, 0, SHARED, 0))
            elif hits := trie.search(form):
                out.append((x, 4, *min(hits)))
        return pd.DataFrame(out, columns=["value", "kind", "distance", "priority", "id"])

    heads = ref.frame.mapInPandas(head_rows, "alias string, size int, id long").groupBy("alias", "size").agg(F.count_distinct("id").alias("n"), F.min("id").alias("id"))
    heads = heads.where("n > 1 or size > 4").select("alias", "size", F.when(F.col("n") > 1, SHARED).otherwise(1).alias("priority"), F.when(F.col("n") > 1, 0).otherwise(F.col("id")).alias("id"))
    entries = ref.frame.mapInPandas(alias_rows, "alias string, size int, priority int, id long").unionByName(heads)
    shards = entries.groupBy("size").agg(F.ceil(F.count("*") / shard_aliases).cast("int").alias("shards"))
    distinct = materialize(values.select("value").where(~F.col("value").rlike(r"(?U)^\s*$")).distinct())
    salts = 1 + distinct.count() // salt_values
    asked = distinct.mapInPandas(asked_rows, "value string, nth int, form string, size int").join(shards, "size")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int")).drop("shards")
    entries = entries.join(shards, "size").withColumn("shard", F.pmod(F.xxhash64("alias"), F.col("shards")).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).drop("shards")
    keys = ["size", "shard", "salt"]
    hits = asked.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInPandas(run, "value string, kind int, distance int, priority int, id long")
    best = hits.groupBy("value").agg(F.min(F.struct("kind", "distance", "priority", "id")).alias("b")).select("value", F.col("b.id").alias("ref_id"))
    return distinct.join(best, "value", "left").select("value", F.coalesce("ref_id", F.lit(0).cast("long")).alias("ref_id"))
