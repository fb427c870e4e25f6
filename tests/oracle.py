"""Comparison of a Spark query with its SQL in DuckDB over the same Parquet files."""

import glob
import math
import os

import duckdb
import pandas as pd


def connect(d: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{d}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if v is None or v is pd.NA or v != v:
        return None
    v = v.item() if hasattr(v, "item") else v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v if isinstance(v, (bool, int)) else str(v)


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(plain(v) for v in r) for r in pdf.itertuples(index=False)), key=repr)
