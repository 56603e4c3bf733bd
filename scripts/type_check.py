"""Compare result column types of each query (Spark) with its oracle SQL (DuckDB)."""
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

import duckdb

from lotmarket.plans import catalog
from lotmarket.plans.binding import TABLES
from lotmarket.session import local_session

SPARK_TO_DUCK = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "int": "INTEGER", "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "timestamp_ntz": "TIMESTAMP"}

sf = "/root/testdata/sf0.001"
spark = local_session()
con = duckdb.connect()
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
qs, sqls = catalog.queries(), catalog.oracle_sql()
keys = sys.argv[1:] or [k for k in sqls]
bad = 0
for k in keys:
    df = qs[k](spark, sf)
    st = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rel = con.sql(sqls[k])
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    diffs = [(c, st.get(c), dt.get(c)) for c in sorted(set(st) | set(dt))
             if SPARK_TO_DUCK.get(st.get(c), st.get(c)) != dt.get(c)]
    if diffs:
        bad += 1
        print(k, diffs)
print(bad, "queries with type differences")
