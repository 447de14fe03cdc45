"""Run queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def sort_key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def compare(spark, con, sf_dir: str, name: str) -> str:
    """An empty string if rows, names and kinds of values agree."""
    df = driver.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    left = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=sort_key)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return "" if left else "no rows"
    result = con.sql(sql)
    if sorted(result.columns) != columns:
        return f"columns {columns} against {sorted(result.columns)}"
    order = [result.columns.index(c) for c in columns]
    right = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=sort_key)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for mine, theirs in zip(left, right):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{columns}: {mine} against {theirs}"
    return ""


if __name__ == "__main__":
    from patronlens.session import build_session

    sf = sys.argv[1]
    session = build_session("local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    names = sys.argv[2:] or list(driver.queries())
    connection = duck(sf)
    bad = 0
    for query in names:
        start = time.time()
        try:
            problem = compare(session, connection, sf, query)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "S" if query in driver.oracle_sql() else "R"
        print(f"{query:32s} {kind} {time.time() - start:6.2f}s {'ok' if not problem else 'DIFFERS ' + problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
