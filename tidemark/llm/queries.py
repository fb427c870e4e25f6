"""Problems 4, 7, 8, 9 and 10 over the archive's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import data_rows, has_clock, norm_symbol, strip, utc_time
from ..plans.changes import GRADE_TIME_SQL, SYMBOL_SQL
from ..session import materialize, table
from . import canon, dedupe, langid, mixing, packing
from .tokens import with_token_counts

FIELDS = {"Firm": "firms", "FromGrade": "grades", "ToGrade": "grades"}


def _lists(spark: SparkSession, d: str) -> dict:
    return {"firms": canon.read_list(table(spark, d, "ref_firms"), "firm_id", "firm_name", "short_name"), "grades": canon.read_list(table(spark, d, "ref_grades"), "grade_id", "grade_name")}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canon.match(table(spark, d, "upgrades_downgrades").where(data_rows()), FIELDS, _lists(spark, d)).drop("value")


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values without an entry, and how often each occurs."""
    found = canon.match(table(spark, d, "upgrades_downgrades").where(data_rows()), FIELDS, _lists(spark, d))
    return found.where("ref_id = 0").groupBy("field_name", F.lower(strip("value")).alias("value")).agg(F.count("*").alias("n_rows"))


def _action(c: str):
    """up, down, main, reit or init for any spelling of them; else the text itself."""
    key = F.lower(strip(c))
    out = key
    for word in ("up", "down", "main", "reit", "init"):
        out = F.when(key.startswith(word), word).otherwise(out)
    return out


def rating_actions(spark: SparkSession, d: str) -> DataFrame:
    """row_id, run_id, akey (symbol, firm, grade and action in canonical form), day, t, clock, fg."""
    # The time is parsed below the Python stage, so that it is evaluated once
    at = F.unix_micros(utc_time("GradeDate")).alias("t")
    rows = table(spark, d, "upgrades_downgrades").where(data_rows()).select("row_id", "run_id", norm_symbol("symbol").alias("symbol"), at, has_clock("GradeDate").alias("clock"), *FIELDS, _action("Action").alias("Action"))
    ids = canon.with_ids(rows, FIELDS, _lists(spark, d))
    own = lambda f: F.when(F.col(f"{f}_id") > 0, F.concat(F.lit("#"), F.col(f"{f}_id"))).otherwise(F.lower(strip(f)))
    blank = F.coalesce(strip("Firm") == "", F.lit(True))
    akey = F.concat_ws("|", F.coalesce("symbol", F.lit("")), own("Firm"), F.coalesce(own("ToGrade"), F.lit("")), F.coalesce("Action", F.lit("")))
    fg = own("FromGrade")
    day = F.date_from_unix_date(F.floor(F.col("t") / F.lit(86_400_000_000)).cast("int"))
    return ids.where(~blank).select("row_id", "run_id", akey.alias("akey"), day.alias("day"), "t", "clock", F.when(fg != "", fg).alias("fg"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    rows = rating_actions(spark, d)
    runs = table(spark, d, "upgrades_downgrades").groupBy("run_id").agg(F.min("row_id").alias("at")).orderBy("at").collect()  # one row per batch
    return dedupe.dedupe_batches(rows, "run_id", [r[0] for r in runs])


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return materialize(with_token_counts(table(spark, d, "documents").select("doc_id", "source", "text")))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    caps = [(r[0], r[1]) for r in table(spark, d, "pack_capacities").select("run_name", "capacity_tokens").limit(1001).collect()]
    if len(caps) > 1000:
        raise ValueError("more than 1000 capacities")
    return packing.pack_items(_sized(spark, d).select("doc_id", "n_tokens"), caps)


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers of each size are."""
    return packing.fill_report(p8_packed(spark, d))


def p9_drawn(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_sized(spark, d), table(spark, d, "mix_targets"))[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of each source."""
    return mixing.mix(_sized(spark, d), table(spark, d, "mix_targets"))[1]


def p10_languages(spark: SparkSession, d: str) -> DataFrame:
    """Every document's language, and every departing paragraph's, with confidence."""
    docs, codes = langid.label_index(table(spark, d, "documents"), table(spark, d, "lang_codes"))
    return langid.languages(docs, langid.fit(docs, codes), codes)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_languages(spark, d).where("departs").select("doc_id", "seg_no", "lang_code")


QUERIES = {
    "p4_found": p4_found, "p4_unmatched": p4_unmatched, "p7_found": p7_found, "p8_packed": p8_packed, "p8_report": p8_report, "p9_drawn": p9_drawn, "p9_report": p9_report,
    "p10_found": p10_found, "p10_languages": p10_languages,
}


def _match_sql(words: canon.Words = canon.WORDS) -> str:
    """Common tables up to found(list, value, ref_id): every alias against every value, by the full table of distances."""
    abbreviations = ", ".join(f"('{w}', '{s}')" for w, shorts in words.abbreviations.items() for s in shorts)
    last = ", ".join(f"'{w}'" for w in [*words.abbreviations, *sorted(words.endings)])
    decorations = "(" + words.decoration.removesuffix("$") + ")+$"
    red = lambda x: rf"regexp_replace(lower(replace(strip_accents({x}), '&', ' and ')), '[^\p{{L}}\p{{N}}]+', '', 'g')"
    bare = lambda x: f"regexp_replace({x}, '{words.article}', '', 'i')"
    cut = lambda x: f"regexp_replace({bare(x)}, '{decorations}', '', 'i')"
    undecorated = lambda x: f"CASE WHEN trim({cut(x)}) <> '' THEN {cut(x)} ELSE {bare(x)} END"
    allowed = lambda n: f"CASE WHEN {n} <= 4 THEN 0 WHEN {n} <= 7 THEN 1 WHEN {n} <= 11 THEN 2 ELSE 3 END"
    return f"""WITH RECURSIVE entries AS (SELECT 'firms' AS list, firm_id AS id, firm_name AS name, short_name AS code FROM ref_firms UNION ALL SELECT 'grades', grade_id, grade_name, NULL FROM ref_grades),
    abbr(word, short) AS (VALUES {abbreviations}),
    words AS (SELECT list, id, list_filter(string_split_regex(trim(lower(replace(name, '&', ' and '))), '\\s+'), lambda x: x <> '') AS ws FROM entries WHERE name IS NOT NULL),
    forms(list, id, n, form) AS (SELECT list, id, 0, '' FROM words UNION ALL
        SELECT f.list, f.id, f.n + 1, f.form || alt.x FROM forms f JOIN words w ON w.list = f.list AND w.id = f.id JOIN LATERAL (SELECT w.ws[f.n + 1] AS x UNION ALL SELECT short FROM abbr WHERE word = {red('w.ws[f.n + 1]')}) alt ON true WHERE f.n < len(w.ws)),
    heads(list, id, ws) AS (SELECT list, id, string_split_regex(trim(name), '\\s+') FROM entries WHERE name IS NOT NULL UNION ALL SELECT list, id, ws[1:len(ws) - 1] FROM heads WHERE len(ws) > 1 AND lower(ws[len(ws)]) IN ({last})),
    head AS (SELECT list, id, {red("array_to_string(arg_min(ws, len(ws)), ' ')")} AS h FROM heads GROUP BY list, id),
    alias AS (SELECT list, id, min(p) AS p, a FROM (SELECT f.list, f.id, 1 AS p, {red('f.form')} AS a FROM forms f JOIN words w ON w.list = f.list AND w.id = f.id AND f.n = len(w.ws) UNION ALL SELECT list, id, 1, {red('code')} FROM entries WHERE trim(code) <> '' UNION ALL SELECT list, id, 0, {red('name')} FROM entries
        UNION ALL SELECT list, min(id), 1, h FROM head WHERE length(h) > 4 GROUP BY list, h HAVING count(DISTINCT id) = 1) WHERE a <> '' GROUP BY list, id, a),
    shared AS (SELECT list, h FROM head GROUP BY list, h HAVING count(DISTINCT id) > 1),
    asked AS (SELECT DISTINCT list, value FROM (SELECT 'firms' AS list, "Firm" AS value FROM upgrades_downgrades UNION ALL SELECT 'grades', "FromGrade" FROM upgrades_downgrades UNION ALL SELECT 'grades', "ToGrade" FROM upgrades_downgrades) WHERE value IS NOT NULL AND NOT regexp_matches(value, '^\\s*$')),
    tries AS (SELECT list, value, 0 AS j, {red(undecorated('value'))} AS v FROM asked UNION ALL SELECT list, value, 1, {red('value')} FROM asked),
    hits AS (SELECT t.list, t.value, 2 * t.j AS kind, 0 AS d, a.p, a.id FROM tries t JOIN alias a ON a.list = t.list AND a.a = t.v
        UNION ALL SELECT t.list, t.value, 2 * t.j + 1, 0, 9, 0 FROM tries t JOIN shared s ON s.list = t.list AND s.h = t.v
        UNION ALL SELECT list, value, 4, d, p, id FROM (SELECT t.list, t.value, damerau_levenshtein(t.v, a.a) AS d, a.p, a.id, least(length(t.v), length(a.a)) AS m FROM tries t JOIN alias a ON a.list = t.list AND abs(length(a.a) - length(t.v)) <= 3 WHERE t.v <> '') WHERE d <= {allowed('m')}),
    found AS (SELECT a.list, a.value, coalesce(arg_min(h.id, (h.kind, h.d, h.p, h.id)), 0) AS ref_id FROM asked a LEFT JOIN hits h ON h.list = a.list AND h.value = a.value GROUP BY a.list, a.value)"""


_FIELDS_SQL = " UNION ALL ".join(f"SELECT row_id, '{f}' AS field_name, '{n}' AS list, \"{f}\" AS value FROM upgrades_downgrades WHERE NOT coalesce(no_analyst_coverage, false)" for f, n in FIELDS.items())
_FOUND_SQL = f"{_match_sql()}, p4 AS (SELECT r.row_id, r.field_name, r.list, r.value, f.ref_id FROM ({_FIELDS_SQL}) r JOIN found f ON f.list = r.list AND f.value = r.value WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e.list = r.list AND e.name = r.value))"


def _repeats_sql() -> str:
    """Rating actions in order of arrival within each content, every one against the first rows before it."""
    bare = lambda c: rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    own = lambda c, f: f"CASE WHEN {f}.ref_id > 0 THEN '#' || {f}.ref_id ELSE lower({bare(c)}) END"
    action = f"lower({bare('u.\"Action\"')})"
    word = " ".join(f"WHEN starts_with({action}, '{w}') THEN '{w}'" for w in ("up", "down", "main", "reit", "init"))
    joined = " ".join(f"LEFT JOIN found {a} ON {a}.list = '{FIELDS[c]}' AND {a}.value = u.\"{c}\"" for a, c in (("fi", "Firm"), ("fg", "FromGrade"), ("tg", "ToGrade")))
    entry = "STRUCT(rid BIGINT, t BIGINT, clock BOOLEAN, day BIGINT, fg VARCHAR)"
    return f"""{_match_sql()}, acts AS (SELECT u.row_id AS rid, epoch_us({GRADE_TIME_SQL}) AS t, contains("GradeDate", ':') AS clock, nullif({own('u."FromGrade"', 'fg')}, '') AS fg,
            concat_ws('|', coalesce({SYMBOL_SQL}, ''), {own('u."Firm"', 'fi')}, coalesce({own('u."ToGrade"', 'tg')}, ''), coalesce(CASE {word} ELSE {action} END, '')) AS akey
        FROM upgrades_downgrades u {joined} WHERE NOT coalesce(no_analyst_coverage, false) AND {bare('u."Firm"')} <> ''),
    seq AS (SELECT *, t // 86400000000 AS day, row_number() OVER (PARTITION BY akey ORDER BY rid) AS nr FROM acts WHERE t IS NOT NULL),
    walk(akey, nr, firsts, rid, rep) AS (SELECT DISTINCT akey, CAST(0 AS BIGINT), CAST([] AS {entry}[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM seq UNION ALL
        SELECT akey, nr, CASE WHEN rep IS NULL THEN list_append(firsts, me) ELSE firsts END, rid, coalesce(rep, rid) FROM (SELECT s.akey, s.nr, w.firsts, s.rid, CAST(struct_pack(rid := s.rid, t := s.t, clock := s.clock, day := s.day, fg := s.fg) AS {entry}) AS me,
            list_min(list_transform(list_filter(w.firsts, lambda y: (y.fg IS NULL OR s.fg IS NULL OR y.fg = s.fg) AND CASE WHEN y.clock AND s.clock THEN abs(y.t - s.t) <= 600000000 ELSE y.day = s.day END), lambda y: y.rid)) AS rep FROM walk w JOIN seq s ON s.akey = w.akey AND s.nr = w.nr + 1))
    SELECT rep AS row_id_a, rid AS row_id_b FROM walk WHERE rep <> rid"""


SQL: dict[str, str] = {
    "p7_found": _repeats_sql(),
    "p4_found": f"{_FOUND_SQL} SELECT row_id, field_name, ref_id FROM p4",
    "p4_unmatched": rf"{_FOUND_SQL} SELECT field_name, lower(regexp_replace(value, '^\s+|\s+$', '', 'g')) AS value, count(*) AS n_rows FROM p4 WHERE ref_id = 0 GROUP BY 1, 2",
}
