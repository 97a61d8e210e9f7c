"""Compare each registered Spark query with its DuckDB oracle.

usage: python tools/check.py [--sf DIR] [name ...]

Row count, column names and an order-insensitive hash of the normalised
values must agree (floats rounded to 6 places, timestamps as ISO text).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402

from pressroom.plans.registry import load_all  # noqa: E402
from pressroom.session import local_session  # noqa: E402
from pressroom.sources.tables import TABLES, table_path  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, bool) or isinstance(v, np.bool_):
        return bool(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "DateType": "DATE",
                 "TimestampNTZType": "TIMESTAMP", "FloatType": "FLOAT", "ShortType": "SMALLINT"}


def spark_type_name(dt) -> str:
    name = type(dt).__name__
    if name == "ArrayType":
        return spark_type_name(dt.elementType) + "[]"
    return SPARK_TO_DUCK.get(name, name)


def type_mismatches(sdf, res) -> list[str]:
    duck = {d[0]: str(d[1]) for d in res.description}
    out = []
    for f in sdf.schema.fields:
        a, b = spark_type_name(f.dataType), duck.get(f.name)
        if b is not None and a != b:
            out.append(f"{f.name}: spark {a} vs duck {b}")
    return out


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--tz", default=None, help="session time zone (default UTC)")
    ap.add_argument("--partitions", type=int, default=8)
    ap.add_argument("--conf", action="append", default=[], help="extra session setting k=v")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    reg = load_all()
    names = args.names or sorted(reg)
    spark = local_session(8, shuffle_partitions=args.partitions)
    if args.tz:
        spark.conf.set("spark.sql.session.timeZone", args.tz)
    for kv in args.conf:
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(args.sf, t)}')")
    bad = 0
    for name in names:
        q = reg[name]
        t0 = time.time()
        try:
            sdf = q.build(spark, args.sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.oracle:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(q.oracle)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        ok = ok_cols and len(srows) == len(drows) and hs == hd
        types = type_mismatches(sdf, res)
        if types:
            print(f"TYPE {name}: " + "; ".join(types))
        if ok:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"FAIL {name}: rows {len(srows)} vs {len(drows)}; cols {sorted(scols)} vs {sorted(dcols)}")
            a, b = set(ls), set(ld)
            for x in sorted(a - b)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(b - a)[:3]:
                print("   duck  only:", x[:300])
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
