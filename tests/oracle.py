"""Run registered queries next to their SQL and compare the results.

``python tests/oracle.py [-s sf_dir] [-b rows_per_block] [name ...]``
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


# Spark and SQL type names that mean the same.
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def compare(spark, con, folder: str, name: str, run, sql: str | None) -> str:
    """Empty when equal, else what differs."""
    df = run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    bad = {c: (types[c], kinds[c]) for c in columns if types[c] != kinds[c]}
    if bad:
        return f"types {bad}"
    a, b = normal(got, df.columns), normal(want, columns)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"{len(diff)} of {len(a)} rows differ, first {diff[0]}"
    if not a:
        return "both empty"
    return ""


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("-s", default="/root/testdata/sf0.01")
    args.add_argument("-b", default=None)
    args.add_argument("names", nargs="*")
    a = args.parse_args()
    from __spark_entry__ import oracle_sql, queries
    from sensorloom.session import ROWS_PER_BLOCK, build

    spark = build("local[8]")
    if a.b:
        spark.conf.set(ROWS_PER_BLOCK, a.b)
    con, sqls, failed = connect(a.s), oracle_sql(), 0
    runs = queries()
    for name in a.names or runs:
        start = time.time()
        try:
            problem = compare(spark, con, a.s, name, runs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.time() - start:6.2f}s {'' if name in sqls else '(no SQL) '}{problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
