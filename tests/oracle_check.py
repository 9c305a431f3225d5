"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names (sorted), same row count, same multiset of
rows. Floats are compared after rounding to 9 significant decimals;
timestamps as text. Prints one line per query and exits 1 on a mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    ok = sc == dc and len(sr) == len(dr) and sr == dr
    detail = ""
    if sc != dc:
        detail = f"cols spark={sc} duck={dc}"
    elif len(sr) != len(dr):
        detail = f"rows spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        detail = f"values differ, e.g. {diff}"
    return ok, len(sr), t1 - t0, detail


def main(argv):
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E

    if plain:
        # a bare session, as a caller that never used get_session would build it
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    else:
        from nimbusframe.session import get_session

        spark = get_session("local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"NOSQL {name}: rows={df.count()}")
            continue
        try:
            ok, n, sec, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, sec, detail = False, -1, 0.0, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: rows={n} {sec:.1f}s {detail}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
