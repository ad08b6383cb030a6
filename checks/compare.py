"""Run registered queries and their SQL twins side by side.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool) and abs(value) < 2**53:
        return float(value)
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_cell(v) for v in row) for row in frame.itertuples(index=False, name=None)), key=repr)


def difference(got: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    got = got[sorted(got.columns)]
    expected = expected[sorted(expected.columns)]
    for c in got.columns:
        if got[c].isna().sum() != expected[c].isna().sum():
            return f"{c}: {got[c].isna().sum()} missing != {expected[c].isna().sum()}"
    a, b = rows_of(got), rows_of(expected)
    if a != b:
        unmatched = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
        return f"{len(unmatched)} rows differ, first {unmatched[0]}; types {got.dtypes.to_dict()} / {expected.dtypes.to_dict()}"
    return None


def main() -> int:
    from roomtide.session import local_session

    from . import ORACLES, QUERIES

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name in ORACLES:
                error = difference(got, con.execute(ORACLES[name]).df())
                status = "ok" if error is None else f"DIFFERENT {error}"
            else:
                error, status = None, "rows only"
        except Exception as e:  # report and go on with the next query
            got, took, error, status = [], time.time() - start, e, f"ERROR {type(e).__name__} {str(e)[:600]}"
        failed += error is not None
        print(f"{name:34s} {len(got):7d} rows {took:6.2f}s {status}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
