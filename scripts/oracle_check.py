"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

usage: python scripts/oracle_check.py [sf_dir] [key ...]
"""
import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

import duckdb

from lotmarket.plans import catalog
from lotmarket.plans.binding import TABLES
from lotmarket.session import local_session


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 4) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 4)
    return v


def rows_key(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs = catalog.queries()
    sqls = catalog.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r[c] for c in sorted(cols)) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {k}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sqls:
            print(f"rows-only {k}: {len(srows)} rows {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[k])
            dcols = [d[0] for d in res.description]
            drows_raw = res.fetchall()
            drows = [tuple(r[dcols.index(c)] for c in sorted(dcols)) for r in drows_raw]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SQL {k}: {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(dcols):
            print(f"MISMATCH-COLS {k}: spark={sorted(cols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_key(srows), rows_key(drows)
        if a == b:
            print(f"ok {k}: {len(a)} rows {ts:.1f}s")
        else:
            bad += 1
            print(f"MISMATCH {k}: spark {len(a)} rows, duck {len(b)} rows")
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diff:
                print("   spark", x)
                print("   duck ", y)
    print(f"{bad} problems")


if __name__ == "__main__":
    main()
