"""Compare registered queries with their SQL in DuckDB: columns, types, rows and values.

    python -m suite.check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import glob
import math
import os
import time

from suite.catalog import ORACLES, QUERIES

MAY_BE_EMPTY = {"scan_empty_typed"}
DEFAULT_DIR = "/root/testdata/sf0.01"

_KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def _sorted(rows, order):
    shaped = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(shaped, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def compare(spark, con, name: str, sf_dir: str, may_be_empty: bool = False) -> str | None:
    """Difference between the two sides; None when equal."""
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    if name not in ORACLES:
        return None if got else "no rows"
    cursor = con.execute(ORACLES[name])
    columns = [(d[0], str(d[1])) for d in cursor.description]
    want = cursor.fetchall()
    mine = dict(df.dtypes)
    theirs = {n: _KINDS.get(t, t.lower()) for n, t in columns}
    if mine != theirs:
        return f"columns differ: {sorted(set(mine.items()) ^ set(theirs.items()))}"
    names = sorted(mine)
    a = _sorted(got, [df.columns.index(n) for n in names])
    b = _sorted(want, [[c for c, _ in columns].index(n) for n in names])
    if len(a) != len(b):
        only = [r for r in a if r not in set(b)][:2], [r for r in b if r not in set(a)][:2]
        return f"{len(a)} rows, expected {len(b)}; {names} {only}"
    for x, y in zip(a, b):
        if x != y:
            return f"{names}: {x} expected {y}"
    return None if a or may_be_empty or name in MAY_BE_EMPTY else "no rows"


def main() -> None:
    from fathom.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default=DEFAULT_DIR)
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(options.sf)
    failed = 0
    chosen = [n for n in QUERIES if not options.names or any(p in n for p in options.names)]
    for name in chosen:
        start = time.time()
        try:
            problem = compare(spark, con, name, options.sf)
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        mark += "" if name in ORACLES else " (rows only)"
        print(f"{mark} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    spark.stop()


if __name__ == "__main__":
    main()
