"""Vendor payloads to rows: JSON objects, lists and tagged unions of tables, with usable names and cleaned values.

Payloads are strings in a column, one per (symbol, dataset); a UDTF-like mapInPandas stage turns each into records as JSON text, and
native from_json gives them the dataset's types. Nothing comes to the driver but column names.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from ..schemas import PROFILE_FIELDS, SCHEMAS, SPELLINGS

TABLE_COLUMN = {"estimates": "estimate_table", "earnings": "earnings_table", "holders": "holders_table"}


def usable_name(name: str) -> str:
    """Identifiers stay; other names get letters, digits and '_' only, '%' as pct."""
    if name.isidentifier():
        return name
    words = re.findall(r"[0-9A-Za-z]+", re.sub(r"\(%\)|%", " pct ", name))
    return "_".join(words).lower() or "unnamed"


def clean(value: object) -> object:
    """Lists joined by ', ' (null if nothing is in them), NaN as null, midnight times as dates; other values as they are."""
    if isinstance(value, list):
        parts = [str(c) for v in value if (c := clean(v)) is not None]
        return ", ".join(parts) or None
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, str) and (m := re.fullmatch(r"(\d{4}-\d{2}-\d{2})[T ]00:00:00(\.0+)?", value)):
        return m[1]
    return value


def core_name(dataset: str, name: str) -> str:
    """The core spelling of a payload's column."""
    wanted = {s: c for c, spellings in SPELLINGS.items() for s in [c, *spellings]} if dataset == "estimates" else {}
    return wanted.get(name) or wanted.get(usable_name(name)) or usable_name(name)


def payload_rows(dataset: str, payload: object) -> list[dict]:
    """Records of one decoded payload."""
    table = TABLE_COLUMN.get(dataset)
    if table and isinstance(payload, dict):
        return [r | {table: name} for name, part in payload.items() for r in payload_rows("", part)]
    if dataset == "shares_outstanding" and isinstance(payload, dict) and "as_of_date" not in payload:
        return [{"as_of_date": clean(k), "shares_outstanding": clean(v)} for k, v in payload.items()]
    records = payload if isinstance(payload, list) else [payload] if payload else []
    out = [{str(k): clean(v) for k, v in r.items()} for r in records if isinstance(r, dict)]
    return [{f: r.get(f) for f in PROFILE_FIELDS} for r in out] if dataset == "profile" else out


def _explode(dataset: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for symbol, at, text in zip(pdf["symbol"], pdf["snapshot_utc"], pdf["payload"], strict=True):
                try:
                    payload = json.loads(text) if text else None
                except ValueError:
                    payload = None
                rows = [{core_name(dataset, k): v for k, v in r.items()} for r in payload_rows(dataset, payload)]
                out.extend((symbol, at, False, json.dumps({k: v for k, v in r.items() if v is not None})) for r in rows)
                if not rows:
                    out.append((symbol, at, True, "{}"))
            yield pd.DataFrame(out, columns=["symbol", "snapshot_utc", "no_analyst_coverage", "record"])

    return run


def parse_payloads(payloads: DataFrame, dataset: str, run_id: str) -> DataFrame:
    """payloads(symbol, snapshot_utc, payload JSON) to typed core rows; a payload without rows gives a marker. A null payload counts as empty.

    Extra vendor fields stay in `extras`, a map of text.
    """
    core = SCHEMAS[dataset]
    rows = payloads.select("symbol", "snapshot_utc", "payload").mapInPandas(_explode(dataset), "symbol string, snapshot_utc string, no_analyst_coverage boolean, record string")
    fields = [f for f in core.fields if f.name not in ("symbol", "snapshot_utc", "dataset", "run_id", "no_analyst_coverage")]
    if dataset == "upgrades_downgrades":
        from ..sources.sinks import canonical_events

        wide = rows.withColumn("m", F.from_json("record", "map<string,string>"))
        names = ["event_utc", "GradeDate", "Date", "gradeDate", "firm", "Firm", "fromGrade", "FromGrade", "toGrade", "ToGrade", "action", "Action"]
        wide = wide.select("symbol", "snapshot_utc", "no_analyst_coverage", *[F.try_element_at("m", F.lit(n)).alias(f"x{i}") for i, n in enumerate(names)], *[F.try_element_at("m", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in fields if f.name in ("priceTargetAction", "currentPriceTarget", "priorPriceTarget")])
        groups = {"event_utc": names[:4], "firm": names[4:6], "fromGrade": names[6:8], "toGrade": names[8:10], "action": names[10:]}
        blank = lambda c: F.when(~F.coalesce(F.col(c).rlike(r"^\s*$"), F.lit(True)), F.col(c))
        wide = wide.withColumns({k: F.coalesce(*[blank(f"x{names.index(n)}") for n in v]) for k, v in groups.items()})
        typed = canonical_events(wide.drop(*[f"x{i}" for i in range(len(names))]))
    else:
        schema = StructType([f for f in fields])
        text = rows.withColumn("m", F.from_json("record", "map<string,string>"))
        bad = lambda c: F.when(~F.lower(F.trim(c)).isin("inf", "+inf", "-inf", "infinity", "-infinity", "nan"), c)
        value = lambda f: (bad(F.try_element_at("m", F.lit(f.name))) if isinstance(f.dataType, DoubleType) else F.try_element_at("m", F.lit(f.name))).try_cast(f.dataType)
        known = [f.name for f in schema.fields]
        typed = text.select("symbol", "snapshot_utc", "no_analyst_coverage", *[value(f).alias(f.name) for f in schema.fields], F.map_filter("m", lambda k, v: ~k.isin(*known)).alias("extras"))
    typed = typed.withColumns({"dataset": F.lit(dataset), "run_id": F.lit(run_id), "no_analyst_coverage": F.when(F.col("no_analyst_coverage"), F.lit(True)).cast(BooleanType())})
    return typed.select(*core.fieldNames(), *([] if dataset == "upgrades_downgrades" else ["extras"]))


def data_bearing(df: DataFrame, metadata: set[str]) -> DataFrame:
    """Rows with a value besides keys and metadata; '' is none, 0 and ' ' are."""
    fields = [c for c in df.columns if c not in metadata]
    if not fields:
        return df.where(F.lit(False))
    given = [F.col(f"`{c}`").isNotNull() & (F.col(f"`{c}`").cast("string") != "") for c in fields]
    keep = given[0]
    for g in given[1:]:
        keep = keep | g
    return df.where(keep)
