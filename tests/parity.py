"""Spark result vs DuckDB oracle: row count, column names, exact values."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _scalar(v):
    import datetime as dt
    import decimal

    if v is None or (isinstance(v, float) and pd.isna(v)):
        return None
    if isinstance(v, str):
        return v
    if isinstance(v, dt.datetime):
        return str(pd.Timestamp(v).tz_localize(None) if v.tzinfo is None else
                   pd.Timestamp(v).tz_convert("UTC").tz_localize(None))
    if isinstance(v, dt.date):
        return str(pd.Timestamp(v))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, bytes):
        return v.decode("utf-8", "replace")
    if hasattr(v, "tolist"):
        v = v.tolist()
    return repr(v)


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            if getattr(s.dt, "tz", None) is not None:
                s = s.dt.tz_convert("UTC").dt.tz_localize(None)
            df[c] = s.astype("datetime64[us]").map(lambda v: None if pd.isna(v) else str(v))
        elif s.dtype == object:
            df[c] = s.map(_scalar)
        elif pd.api.types.is_float_dtype(s):
            df[c] = s.astype("float64")
        elif pd.api.types.is_bool_dtype(s):
            df[c] = s.astype(object)
        elif pd.api.types.is_integer_dtype(s):
            df[c] = s.astype("Int64")
    df = df.astype(object).where(pd.notna(df), None)
    key = df.astype(str)
    order = key.sort_values(list(key.columns)).index
    return df.loc[order].reset_index(drop=True)


def compare(spark_df, sql: str, con, show: int = 5) -> tuple[bool, str]:
    left = spark_df.toPandas()
    right = con.execute(sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"row counts differ: spark {len(left)} vs oracle {len(right)}"
    a, b = _norm(left), _norm(right)
    bad = []
    for c in a.columns:
        x, y = a[c], b[c]
        diff = [(i, x[i], y[i]) for i in range(len(x))
                if not (x[i] == y[i] or (x[i] is None and y[i] is None)
                        or (isinstance(x[i], float) and isinstance(y[i], float)
                            and pd.isna(x[i]) and pd.isna(y[i])))]
        if diff:
            bad.append(f"{c}: {len(diff)} rows differ, e.g. {diff[:show]}")
    if bad:
        return False, "; ".join(bad)
    return True, f"{len(a)} rows equal"
