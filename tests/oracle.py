"""Runs queries beside their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    out = pd.DataFrame({c: df[c].map(lambda v: "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)) for c in df.columns})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def by_sql(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con.execute(sql).df()


def same(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> bool:
    return rows_of(spark_rows).equals(rows_of(sql_rows))
