"""Compare a query with its SQL on the same tables, value by value."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sql: str, sf_dir: str) -> pd.DataFrame:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db.execute(sql).df()


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        df[c] = df[c].astype(object).where(df[c].notna(), None).map(
            lambda v: None if v is None else (repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))
        )
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = normal(got), normal(want)
    bad = (a.fillna("\0") != b.fillna("\0")).any(axis=1)
    if bad.any():
        return f"{bad.sum()} rows differ, e.g.\n{a[bad].head(3)}\n{b[bad].head(3)}"
    return None
