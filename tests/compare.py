"""Order-insensitive comparison of two result tables."""

from __future__ import annotations

import math
from pathlib import Path

import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def register_views(con, sf_dir: str) -> None:
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")


def _cell(value: object) -> str:
    if value is None or value is pd.NA or value is pd.NaT:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if hasattr(value, "item"):
        return _cell(value.item())
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return str(value)


def table_rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = sorted(df.columns)
    lists = [[_cell(v) for v in df[c].tolist()] for c in columns]
    return sorted(zip(*lists, strict=True))


def compare_tables(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    for c in got.columns:
        # Whole numbers with nulls come as doubles from one side and as masked integers from the other.
        if {got[c].dtype.name, want[c].dtype.name} == {"float64", "Int64"}:
            got, want = got.astype({c: "Int64"}), want.astype({c: "Int64"})
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    a, b = table_rows(got), table_rows(want)
    different = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if different:
        return f"{len(different)} rows differ, first {different[0]}"
    for c in got.columns:
        if got[c].dtype.kind != want[c].dtype.kind:
            return f"type of {c}: {got[c].dtype} != {want[c].dtype}"
    return ""
