"""Compare registered queries with their DuckDB twins: python -m tests.oracle SF_DIR [names]."""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

import duckdb

import __spark_entry__ as driver
from hazeline.session import build_session


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def check(spark, con, name, sf_dir, may_be_empty=False):
    """Empty text when equal, else what differs."""
    df = driver.queries()[name](spark, sf_dir)
    got = table_rows(df.columns, [tuple(r) for r in df.collect()])
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).upper() for d in result.description}
    want = table_rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    for field, kind in df.dtypes:
        if KINDS.get(kind) != types[field]:
            return f"type of {field}: spark {kind}, duckdb {types[field]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if not want and not may_be_empty:
        return "no rows on both sides"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(want)} rows differ, first {bad[0]}" if bad else ""


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="hazeline-oracle-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in [n for n in driver.queries() if not names or any(n.startswith(p) for p in names)]:
        start = time.time()
        try:
            problem = check(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        mark = "FAIL" if problem else "ok  "
        print(f"{mark} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
