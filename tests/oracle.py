"""Compare a query's rows with DuckDB's for its SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        source = f"{f}/*.parquet" if os.path.isdir(f) else f
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{source}'")
    return c


def plain(v: object) -> str:
    if v is None or v is pd.NA or v != v:
        return ""
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else repr(round(v, 6))
    return str(v)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False))


def same(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> None:
    assert sorted(spark_rows.columns) == sorted(sql_rows.columns)
    a, b = rows(spark_rows), rows(sql_rows)
    assert len(a) == len(b)
    assert [x for x, y in zip(a, b, strict=True) if x != y][:3] == []
