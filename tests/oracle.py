"""Compare a query's rows with those of its SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(data: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def _plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "mM":
            df[c] = df[c].astype(str)
        elif df[c].dtype.kind in "iufb":
            df[c] = df[c].astype(float).round(7) + 0.0
        else:
            df[c] = df[c].map(lambda v: None if v is None or v != v else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def assert_same(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> None:
    assert sorted(spark_rows.columns) == sorted(sql_rows.columns)
    a, b = _plain(spark_rows), _plain(sql_rows)
    assert len(a) == len(b)
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-7, atol=1e-7)
