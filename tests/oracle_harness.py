"""Run catalogue queries in Spark and their SQL in DuckDB; compare rows, names, types, values.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(canon(r[c]) for c in cols) for r in df.collect()]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return cols, sorted(rows), types


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    types = dict(zip(names, [str(t) for t in rel.types]))
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(canon(r[i]) for i in idx) for r in rel.fetchall()]
    return cols, sorted(rows), types


def compare(spark, sf: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as e

    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            s_cols, s_rows, s_types = spark_rows(qs[name](spark, sf))
        except Exception as ex:  # noqa: BLE001
            out[name] = ("SPARK_ERROR", repr(ex)[:400])
            print(name, "SPARK_ERROR", repr(ex)[:400], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            out[name] = ("NO_ORACLE", len(s_rows))
            print(name, "NO_ORACLE", len(s_rows), flush=True)
            continue
        try:
            d_cols, d_rows, d_types = duck_rows(con, sqls[name])
        except Exception as ex:  # noqa: BLE001
            out[name] = ("SQL_ERROR", repr(ex)[:400])
            print(name, "SQL_ERROR", repr(ex)[:400], flush=True)
            continue
        status = "OK"
        detail = ""
        if s_cols != d_cols:
            status, detail = "COLS", f"{s_cols} vs {d_cols}"
        elif len(s_rows) != len(d_rows):
            status, detail = "ROWS", f"{len(s_rows)} vs {len(d_rows)}"
        elif s_rows != d_rows:
            diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
            status, detail = "VALUES", str(diff)[:600]
        tdiff = {c: (s_types[c], d_types[c]) for c in s_cols if c in d_types}
        out[name] = (status, len(s_rows), round(t1 - t0, 2), detail)
        if verbose:
            print(f"{name:28s} {status:7s} rows={len(s_rows):6d} t={t1 - t0:5.2f}s {detail}", flush=True)
            if verbose == "types" or status != "OK":
                print("   types:", tdiff, flush=True)
    return out


if __name__ == "__main__":
    from covenant.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(int(os.environ.get("CORES", 8)))
    res = compare(spark, sf, names, verbose="types" if os.environ.get("TYPES") else True)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    print(f"\n{len(res) - len(bad)}/{len(res)} OK; not OK: {sorted(bad)}")
