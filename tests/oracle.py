"""Runs queries and their SQL twins on the same tables and compares the results.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricewright.queries import ORACLES, QUERIES  # noqa: E402
from pricewright.session import local_session  # noqa: E402


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, folder: str) -> str:
    """'' when equal, else the first difference."""
    df = QUERIES[name](spark, folder)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return "" if got else "no rows"
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = _rows(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    wrong = [(c, t, kinds[c]) for c, t in df.dtypes if kinds[c] not in (names.get(t), "STRING" if t == "string" else None)]
    if wrong:
        return f"types {wrong}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} against {w}"
    return ""


if __name__ == "__main__":
    folder, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = local_session(8), duck(folder)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as e:  # noqa: BLE001 - a report of all queries is wanted
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{'ok  ' if not problem else 'FAIL'} {name}{kind} {time.time() - start:.1f}s {problem[:700]}", flush=True)
        bad += bool(problem)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
