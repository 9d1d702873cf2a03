"""Run registered queries against their SQL in DuckDB and report differences.

``python -m harness.compare [--sf DIR] [name ...]``
"""

from __future__ import annotations

import argparse
import math
import os
import time

import duckdb
from pyspark.sql import SparkSession

from gaugeline.llm import queries as corpus
from harness import queries

QUERIES = {**queries.QUERIES, **corpus.QUERIES}
ORACLES = {**queries.ORACLES, **corpus.ORACLES}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[bool, str]:
    """(equal, description): same columns, same Python types, same values, bit for bit."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(got) != len(want):
        return False, f"rows {len(got)} / {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return False, f"first difference {g} / {w}"
    return True, f"{len(got)} rows"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (SparkSession.builder.master(f"local[{os.cpu_count()}]")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        begin = time.time()
        if name not in ORACLES:
            print(f"--   {name}: {QUERIES[name](spark, args.sf).count()} rows, no SQL")
            continue
        try:
            equal, note = compare(spark, con, args.sf, name)
        except Exception as error:  # report and go on with the others
            equal, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not equal
        print(f"{'ok  ' if equal else 'FAIL'} {name} {time.time() - begin:.1f}s {note}", flush=True)
    print(f"{bad} of {len(args.names or QUERIES)} differ")


if __name__ == "__main__":
    main()
