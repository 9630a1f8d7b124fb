"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Rows are compared as multisets after sorting columns by name, like the driver.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def duck_conn(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark type name -> DuckDB type name of the same values
DUCK_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
             "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
             "date": "DATE"}


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = df.collect()
    t1 = time.time()
    s_cols, s_vals = rows_of(df.columns, s_rows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_vals), spark_s=round(t1 - t0, 2), note="no oracle")
    rel = con.sql(sql)
    d_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    d_cols, d_vals = rows_of(list(rel.columns), rel.fetchall())
    out = dict(name=name, rows=len(s_vals), oracle_rows=len(d_vals), spark_s=round(t1 - t0, 2))
    if s_cols != d_cols:
        out.update(ok=False, note=f"columns differ: {s_cols} vs {d_cols}")
        return out
    types = [(c, t, d_types[c]) for c, t in df.dtypes if DUCK_TYPE.get(t, t) != d_types[c]]
    if types:
        out.update(ok=False, note=f"types differ: {types}")
        return out
    if s_vals != d_vals:
        sa, da = set(s_vals), set(d_vals)
        out.update(ok=False, note=f"values differ: only spark {list(sa - da)[:2]} only duck {list(da - sa)[:2]}")
        return out
    out["ok"] = True
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tidewater.session import build_session
    import __spark_entry__ as E
    extra = {"spark.sql.session.timeZone": os.environ["CHECK_TZ"]} if os.environ.get("CHECK_TZ") else None
    spark = build_session("local[8]", int(os.environ.get("CHECK_PARTITIONS", "8")), extra=extra)
    con = duck_conn(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(name=name, ok=False, note=f"error: {type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
