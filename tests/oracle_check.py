"""Run every registered query and its DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, schema and an order-insensitive value hash.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from searchlens.session import local_session  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def value_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    digests = sorted(hashlib.md5(repr(tuple(_norm(r[i]) for i in order)).encode()).hexdigest() for r in rows)
    return hashlib.md5("".join(digests).encode()).hexdigest()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if sql is None:
        return f"{name:32s} rows={len(rows):7d} spark={t1 - t0:6.2f}s (no oracle)", True
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    types_ok = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    ok = (sorted(cols) == sorted(ocols) and len(rows) == len(orows) and types_ok
          and value_hash(cols, rows) == value_hash(ocols, orows))
    msg = f"{name:32s} rows={len(rows):7d}/{len(orows):7d} spark={t1 - t0:6.2f}s {'OK' if ok else 'MISMATCH'}"
    if not ok and sorted(cols) != sorted(ocols):
        msg += f" cols {cols} vs {ocols}"
    if not types_ok:
        msg += f" types {df.dtypes} vs {duck_types}"
    return msg, ok


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as se

    if os.environ.get("PLAIN_SESSION"):
        # the driver's own kind of session: defaults only
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "America/Los_Angeles")
                 .getOrCreate())
    else:
        spark = local_session()
    con = duck(sf_dir)
    oracle = se.oracle_sql()
    bad = 0
    for name, fn in se.queries().items():
        if only and name not in only:
            continue
        try:
            msg, ok = compare(spark, con, sf_dir, name, fn, oracle.get(name))
        except Exception as e:  # report and go on
            msg, ok = f"{name:32s} ERROR {type(e).__name__}: {str(e)[:300]}", False
        bad += not ok
        print(msg, flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
