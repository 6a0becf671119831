"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Mirrors the driver's check: row count, column names, column types and an
order-insensitive comparison of exact values.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from trolley.session import get_spark  # noqa: E402
from trolley.sources.tables import TABLES  # noqa: E402

TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
            "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return "D" + str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir, verbose=False):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    stypes = [TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema]
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = [str(t) for t in rel.types]
    drows = rel.fetchall()
    res = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(t1 - t0, 2)}
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={sorted(scols)} oracle={sorted(dcols)}")
    else:
        sm = dict(zip(scols, stypes))
        dm = dict(zip(dcols, dtypes))
        bad = [(c, sm[c], dm[c]) for c in sorted(scols) if sm[c] != dm[c]]
        if bad:
            problems.append(f"types {bad}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sset = sorted(tuple(canon(r[i]) for i in si) for r in srows)
        dset = sorted(tuple(canon(r[i]) for i in di) for r in drows)
        if len(srows) != len(drows):
            problems.append(f"rowcount {len(srows)} vs {len(drows)}")
        if sset != dset:
            diff_s = [r for r in sset if r not in set(dset)][:3]
            diff_d = [r for r in dset if r not in set(sset)][:3]
            problems.append(f"values differ; cols={order}\n   spark-only={diff_s}\n   oracle-only={diff_d}")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("-")]
    spark = get_spark("local[8]", 8, extra={"spark.driver.memory": "8g"})
    import __spark_entry__
    qs, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    con = duck(sf_dir)
    todo = names or sorted(qs)
    fails = 0
    for n in todo:
        try:
            r = compare(spark, con, n, qs[n], sql.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": "ERROR", "problems": [f"{type(e).__name__}: {str(e)[:800]}"]}
            if "-v" in argv:
                traceback.print_exc()
        if r["status"] in ("FAIL", "ERROR"):
            fails += 1
        print(r["status"].ljust(9), n.ljust(32), {k: v for k, v in r.items()
                                                  if k not in ("name", "status", "problems")})
        for p in r.get("problems", []):
            print("   ", p)
        sys.stdout.flush()
    print(f"{len(todo) - fails}/{len(todo)} passed")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
