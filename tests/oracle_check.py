"""Run every registered query in Spark and its DuckDB twin; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names, same row count, and the same multiset of
rows after normalising values (floats to 9 significant digits, dates and
timestamps to ISO text, null/NaN to one marker).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def duck_connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark type -> DuckDB type of the same values
TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
            "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def compare(spark, con, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_types = {f.name: TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
    d_types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = rows_of(d_cols, cur.fetchall())
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    elif s_types != d_types:
        diff = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
        problems.append(f"types differ {diff}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return len(s_rows), problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as e
    from runway.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:40s} (no oracle)")
            continue
        t0 = time.time()
        try:
            n, problems = compare(spark, con, name, q, sqls[name], sf_dir)
        except Exception as ex:  # report and continue
            n, problems = -1, [f"error: {type(ex).__name__}: {str(ex)[:400]}"]
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name:40s} rows={n:<7d} {time.time() - t0:5.1f}s {'; '.join(problems)}")
    print(f"{len(qs)} queries, {bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
