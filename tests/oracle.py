"""Compare the result of a registered query with its SQL on the given tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, sf_dir: str, sql: str) -> list[str]:
    """What sets a result apart from that of its SQL, in words; empty if nothing does."""
    found = [tuple(row) for row in frame.collect()]
    cursor = connect(sf_dir).execute(sql)
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    problems = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} <> {sorted(names)}"]
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows <> {len(expected)}")
    left, right = _rows(frame.columns, found), _rows(names, expected)
    for row in list((left - right))[:2]:
        problems.append(f"only in Spark: {row}")
    for row in list((right - left))[:2]:
        problems.append(f"only in SQL: {row}")
    return problems
