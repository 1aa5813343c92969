"""Run a registered query and its DuckDB oracle side by side and compare.

Comparison mirrors the driver contract: same column names, same row count,
same multiset of rows after sorting columns by name and rounding floats.
"""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from segmetric.sources.tables import TABLES


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def canon(pdf: pd.DataFrame, digits: int = 5) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v, digits) for v in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, sql: str, sf_dir: str, con=None, digits: int = 5) -> tuple[bool, str]:
    con = con or duck_connect(sf_dir)
    got = spark_df.toPandas()
    exp = con.execute(sql).fetchdf()
    if sorted(got.columns) != sorted(exp.columns):
        return False, f"columns differ: {sorted(got.columns)} vs {sorted(exp.columns)}"
    if len(got) != len(exp):
        return False, f"row count {len(got)} vs {len(exp)}"
    a, b = canon(got, digits), canon(exp, digits)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, first: {diffs}"
    return True, f"{len(got)} rows"
