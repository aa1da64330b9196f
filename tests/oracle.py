"""Compare one registered query with its DuckDB text on the same files."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        return f"f{value!r}"
    if isinstance(value, Decimal):
        return f"d{value}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def rows(names, records) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("|".join(normal(r[i]) for i in order) for r in records)


def compare(frame, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    got = frame.collect()
    cursor = con.execute(sql)
    wanted_names = [c[0] for c in cursor.description]
    wanted = cursor.fetchall()
    if sorted(frame.columns) != sorted(wanted_names):
        return f"columns {sorted(frame.columns)} != {sorted(wanted_names)}"
    a, b = rows(frame.columns, got), rows(wanted_names, wanted)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    if not a:
        return "both empty"
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(differing)} rows differ, e.g. {differing[0]}" if differing else None
