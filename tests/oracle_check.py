"""Spark result vs DuckDB oracle, the way the driver's gate compares them.

Columns are matched by name; rows as an order-free multiset after
normalising values (floats to 9 significant decimals, dates as ISO text).

    python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb
import numpy as np

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ledgerlight.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, (float, np.floating)):
        if math.isnan(v):
            return None
        return round(float(v), 9) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9) + 0.0
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (dt.datetime,)):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in records], [cols[i] for i in order]


def spark_types(df) -> dict:
    from pyspark.sql import types as T
    names = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.ShortType: "SMALLINT",
             T.ByteType: "TINYINT", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
             T.StringType: "VARCHAR", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
             T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.BooleanType: "BOOLEAN",
             T.BinaryType: "BLOB"}

    def name(dt):
        if isinstance(dt, T.DecimalType):
            return f"DECIMAL({dt.precision},{dt.scale})"
        if isinstance(dt, T.ArrayType):
            return name(dt.elementType) + "[]"
        return names.get(type(dt), dt.simpleString())
    return {f.name: name(f.dataType) for f in df.schema.fields}


def duck_types(con, sql) -> dict:
    rel = con.sql(sql)
    return {c: str(t) for c, t in zip(rel.columns, rel.types)}


def spark_result(df):
    cols = df.columns
    recs = [tuple(r) for r in df.collect()]
    return rows_of(cols, recs)


def duck_result(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    recs = cur.fetchall()
    return rows_of(cols, recs)


def compare(spark, con, key, sf_dir, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = spark_types(sdf)
    s_rows, s_cols = spark_result(sdf)
    t1 = time.time()
    d_rows, d_cols = duck_result(con, sql)
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    if s_cols != d_cols:
        out["status"] = "COLUMNS"
        out["detail"] = f"spark={s_cols} oracle={d_cols}"
        return out
    d_types = duck_types(con, sql)
    if s_types != d_types:
        diff = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                if s_types.get(c) != d_types.get(c)}
        out["types"] = f"type differences (spark, oracle): {diff}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs == cd:
        out["status"] = "OK"
    else:
        out["status"] = "VALUES"
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        out["detail"] = f"cols={s_cols}\n  spark-only={only_s}\n  oracle-only={only_d}"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from ledgerlight.session import build_session
    import __spark_entry__ as entry
    spark = build_session("local[8]", shuffle_partitions=int(os.environ.get("CHECK_PARTITIONS", "8")),
                          extra={"spark.sql.session.timeZone": os.environ.get("CHECK_TZ", "UTC")})
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        if key not in sqls:
            n = qs[key](spark, sf_dir).count()
            print(f"{key:28s} ROWS-ONLY rows={n}")
            continue
        try:
            r = compare(spark, con, key, sf_dir, qs[key], sqls[key])
        except Exception as e:  # report and continue
            r = {"key": key, "status": "ERROR", "detail": repr(e)[:800]}
        bad += r["status"] != "OK"
        print(f"{key:28s} {r['status']:8s} spark={r.get('spark_rows')} oracle={r.get('oracle_rows')} "
              f"t={r.get('spark_sec')}")
        if "detail" in r:
            print("  " + r["detail"])
        if "types" in r:
            print("  " + r["types"])
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
