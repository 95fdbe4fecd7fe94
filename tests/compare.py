"""Compare query results with their SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(_plain(row[i])) for i in order) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the two, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    want = _rows(names, cursor.fetchall())
    have = _rows(result.columns, [tuple(r) for r in result.collect()])
    if want == have:
        return None
    only_have = [r for r in have if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(have)][:2]
    return f"{len(have)} rows against {len(want)}; only here {only_have}; only there {only_want}"
