"""Compares a named query with its SQL on DuckDB, column by column and row by row."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return repr([plain(v) for v in value])
    if isinstance(value, dict):
        return repr(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows])


def compare(df, con, sql) -> str | None:
    """None if equal, else a short account of the difference."""
    result = con.execute(sql)
    expected = table_of([d[0] for d in result.description], result.fetchall())
    actual = table_of(df.columns, [tuple(r) for r in df.collect()])
    if expected[0] != actual[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if len(expected[1]) != len(actual[1]):
        return f"{len(actual[1])} rows instead of {len(expected[1])}"
    wrong = [(a, e) for a, e in zip(actual[1], expected[1]) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual[1])} rows differ, e.g. {wrong[0][0]} instead of {wrong[0][1]}"
    return None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from casecurve.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = "ok" if problem is None else problem
            else:
                problem, note = None, f"{len(df.collect())} rows (no SQL)"
        except Exception as err:  # report and go on with the next query
            problem = note = f"{type(err).__name__}: {str(err)[:900]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'pass'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failed")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
