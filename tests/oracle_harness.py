"""Run a registered Spark query and its DuckDB oracle, compare results.

Comparison is order-insensitive: columns by name, rows sorted on all columns,
floats with a small absolute tolerance.
"""
from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x) if x is not None
                                            else (True, "", 0) for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame, tol: float = 1e-3) -> list[str]:
    problems = []
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return [f"columns differ: {sorted(spark_df.columns)} vs {sorted(oracle_df.columns)}"]
    if len(spark_df) != len(oracle_df):
        problems.append(f"row count {len(spark_df)} vs {len(oracle_df)}")
        return problems
    a, b = _rows(spark_df), _rows(oracle_df)
    cols = sorted(spark_df.columns)
    bad = 0
    for ra, rb in zip(a, b):
        for c, x, y in zip(cols, ra, rb):
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) \
                    and not isinstance(x, bool) and not isinstance(y, bool):
                if abs(float(x) - float(y)) > tol * max(1.0, abs(float(y))):
                    bad += 1
                    if bad <= 5:
                        problems.append(f"{c}: {x} vs {y} in {ra}")
            elif x != y:
                bad += 1
                if bad <= 5:
                    problems.append(f"{c}: {x!r} vs {y!r} in {ra}")
    return problems
