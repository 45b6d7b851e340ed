"""Compare a catalogue query with its SQL on one set of test tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, list):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return str(value)


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs first."""
    frame = query(spark, sf_dir)
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(set(frame.columns) ^ set(columns))} differ"
    ours = normalised(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = normalised(columns, result.fetchall())
    if ours == theirs:
        return None
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, SQL gives {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    cells = next((list(zip(sorted(columns), a, b, strict=True)) for a, b in bad), [])
    return f"{len(bad)} rows differ, first: {[c for c in cells if c[1] != c[2]]}"
