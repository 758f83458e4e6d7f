"""Run the registered queries against their SQL: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

from checks import ORACLES, QUERIES
from safelabel.session import build_session


def cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def table_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def difference(spark, con, sf: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, sf)
    mine = table_of(df.collect(), df.columns)
    if name not in ORACLES:
        return None if mine[1] else "no rows"
    got = con.execute(ORACLES[name])
    theirs = table_of(got.fetchall(), [d[0] for d in got.description])
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = {c: str(t) for c, t in zip([d[0] for d in got.description], [d[1] for d in got.description])}
    odd = [f"{c} {t} {types[c]}" for c, t in df.dtypes if kinds.get(t) != types[c]]
    if mine[1] != theirs[1]:
        a, b = set(mine[1]), set(theirs[1])
        return f"{len(mine[1])} rows against {len(theirs[1])}; only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}"
    return f"types {odd}" if odd else (None if mine[1] else "no rows on both sides")


def main(argv):
    sf = f"/root/testdata/{argv[0] if argv else 'sf0.001'}"
    names = argv[1:] or sorted(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name in names:
        began = time.time()
        try:
            found = difference(spark, con, sf, name)
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - began:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
