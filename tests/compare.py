"""Run a query in Spark and its SQL in DuckDB on the same folder and compare the results."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].dt.date
    text = df.astype(object).where(df.notna(), None).map(lambda v: "NULL" if v is None else repr(v) if isinstance(v, float) else str(v))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(spark_result: pd.DataFrame, sql_result: pd.DataFrame) -> str:
    """Empty when both hold the same rows, else a description of the first difference."""
    a, b = _canonical(spark_result), _canonical(sql_result)
    if list(a.columns) != list(b.columns):
        return f"columns {list(a.columns)} != {list(b.columns)}"
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    unequal = (a != b).any(axis=1)
    if unequal.any():
        i = unequal.idxmax()
        return f"{unequal.sum()} rows differ, first:\n{a.loc[i].to_dict()}\n{b.loc[i].to_dict()}"
    return ""
