"""Compare queries with their SQL equivalents: python tests/check_oracles.py [sf] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def make_session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return "decimal:" + str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return f"{type(value).__name__}:{value}" if value is not None else None


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return f"rows-only {len(rows)}"
    rel = con.execute(sql)
    expected_cols = [d[0] for d in rel.description]
    expected = rel.fetchall()
    cols, got = table_rows(df.columns, rows)
    ecols, want = table_rows(expected_cols, expected)
    if cols != ecols:
        return f"FAIL columns {cols} vs {ecols}"
    if len(got) != len(want):
        return f"FAIL rows {len(got)} vs {len(want)}: {got[:2]} / {want[:2]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"FAIL {len(bad)}/{len(got)} rows differ, e.g.\n   {cols}\n   {bad[0][0]}\n   {bad[0][1]}"
    return f"ok {len(got)}" if got else "EMPTY"


def main(argv):
    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/{argv[1] if len(argv) > 1 else 'sf0.01'}"
    names = argv[2:]
    spark = make_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    table, sqls = queries(), oracle_sql()
    fails = 0
    for name, fn in table.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as exc:  # report and go on
            text = "".join(traceback.format_exception_only(exc))
            result = "FAIL " + text[:700]
        fails += result.startswith(("FAIL", "EMPTY"))
        print(f"{name:34s} {time.time() - start:6.2f}s {result}", flush=True)
        spark.catalog.clearCache()
    print("failures:", fails, "of", len(table))
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
