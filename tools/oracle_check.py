"""Compare each registered Spark query with its DuckDB twin.

Usage: python tools/oracle_check.py [sf_dir] [key ...]

Checks row count, column names and an order-insensitive hash of the values
(doubles rounded to 6 places, timestamps and dates as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cardsentry.plans.catalog import oracle_sql, queries  # noqa: E402
from cardsentry.session import get_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda j: columns[j])
    lines = sorted("|".join(norm(r[j]) for j in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_diffs(sdf, con, sql):
    """(column, spark type, duckdb type) where the two engines disagree."""
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(st, st.upper())
        if duck.get(f.name) != want:
            out.append((f.name, st, duck.get(f.name)))
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    if os.environ.get("PLAIN_SESSION"):
        # what a driver with default settings would use (1g driver memory)
        from pyspark.sql import SparkSession

        b = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false"))
        if os.environ.get("SESSION_TZ"):
            b = b.config("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
        spark = b.getOrCreate()
    else:
        spark = get_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = queries(), oracle_sql()
    keys = keys or list(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sqls:
            print(f"ROWS {k}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[k])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {k}: columns spark={sorted(scols)} duckdb={sorted(dcols)}")
            bad += 1
            continue
        if os.environ.get("CHECK_TYPES"):
            diffs = type_diffs(sdf, con, sqls[k])
            if diffs:
                print(f"TYPES {k}: {diffs}")
        hs, ls = digest(scols, srows)
        hd, ld = digest(dcols, drows)
        if len(srows) != len(drows) or hs != hd:
            print(f"FAIL {k}: rows spark={len(srows)} duckdb={len(drows)}")
            diff_s = [x for x in ls if x not in set(ld)][:3]
            diff_d = [x for x in ld if x not in set(ls)][:3]
            print("   cols:", sorted(scols))
            print("   spark-only:", diff_s)
            print("   duckdb-only:", diff_d)
            bad += 1
        else:
            print(f"OK   {k}: {len(srows)} rows {ts:.1f}s")
    print(f"{len(keys) - bad}/{len(keys)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
