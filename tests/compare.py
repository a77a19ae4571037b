"""Runs registered queries against their check SQL in DuckDB.

    python tests/compare.py SF_DIR [name ...]
"""

import datetime
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v if isinstance(v, str) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    """Message of the first difference, or None."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    want = rows_of(columns, rel.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows != {len(want)} rows or values differ: got {extra}, expected {missing}"
    return None if got else "no rows"


def main():
    import __spark_entry__ as entry
    from plumbline.session import get_session

    spark = get_session("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    sf_dir, names = sys.argv[1], sys.argv[2:]
    con, checks, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            message = compare(spark, con, sf_dir, name, fn, checks.get(name))
        except Exception as e:  # noqa: BLE001
            message = f"{type(e).__name__}: {str(e)[:600]}"
        bad += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {name} {time.time() - start:.1f}s {'' if name in checks else '(rows only)'} {message or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
