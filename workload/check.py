"""Compare registered queries with their SQL in DuckDB: rows, columns and values.

usage: python -m workload.check SF_DIR [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from workload.views import TABLES
from workload import registry


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, pd.Timestamp):
            return str(v.date())
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return v + 0.0
        return v if isinstance(v, (bool, int)) else str(v)

    rows = [tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, name: str) -> str:
    got_frame = registry.queries()[name](spark, sf_dir).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return f"rows only: {len(got_frame)}"
    want_frame = connect(sf_dir).execute(sql).df()
    if sorted(got_frame.columns) != sorted(want_frame.columns):
        return f"COLUMNS {sorted(got_frame.columns)} / {sorted(want_frame.columns)}"
    got, want = normal(got_frame), normal(want_frame)
    if len(got) != len(want):
        return f"ROWS {len(got)} / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"VALUES {len(wrong)} of {len(got)}: {wrong[0]}"
    return f"ok {len(got)}"


if __name__ == "__main__":
    from workload.session import local_session

    session = local_session()
    folder, *names = sys.argv[1:]
    bad = 0
    for name in names or registry.queries():
        started = time.time()
        try:
            outcome = compare(session, folder, name)
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {str(error)[:600]}"
        bad += not outcome.startswith(("ok", "rows only"))
        print(f"{name:45s} {time.time() - started:6.1f}s {outcome}", flush=True)
    print("failed:", bad)
