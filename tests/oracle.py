"""DuckDB side of the parity checks (same normalisation as the driver's compare)."""

import math
import os

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 9)
        return int(v) if v.is_integer() else v
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return cols, sorted(out, key=key)
