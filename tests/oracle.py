"""Run registered queries and their SQL side by side and compare all values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else value
    return value


def _normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=repr)


def compare(spark_df, connection, sql) -> str | None:
    """A description of the first difference, None where the results are equal."""
    result = connection.execute(sql)
    expected = _normal([c[0] for c in result.description], result.fetchall())
    actual = _normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows, expected {len(expected[1])}"
    for got, want in zip(actual[1], expected[1]):
        if got != want or [type(v) for v in got] != [type(v) for v in want]:
            return f"{got} != {want}"
    return None
