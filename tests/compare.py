"""Run a registered query in Spark and its SQL in the embedded engine, and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(plain(row[i]) for i in order) for row in rows
    )


def expected(con, sql):
    cursor = con.execute(sql)
    return bag([d[0] for d in cursor.description], cursor.fetchall())


def actual(frame):
    return bag(frame.columns, frame.collect())


def difference(frame, con, sql) -> str:
    names, rows = actual(frame)
    wanted_names, wanted = expected(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if rows == wanted:
        return ""
    extra, lost = rows - wanted, wanted - rows
    return (
        f"{sum(rows.values())} rows against {sum(wanted.values())}; "
        f"{sum(extra.values())} extra such as {list(extra)[:3]}; "
        f"{sum(lost.values())} lost such as {list(lost)[:3]}"
    )
