"""Print join strategies per registered query (formatted physical plans)."""
import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from lotmarket.plans import catalog
from lotmarket.session import local_session

SKIP = {"rf_fit", "gbt_fit", "stream_tumbling", "stream_kpi", "stream_dedup", "stream_quality"}

spark = local_session()
d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
jvm = spark._jvm
for k, fn in catalog.queries().items():
    if k in SKIP:
        continue
    df = fn(spark, d)
    p = jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    flags = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin") if w in p]
    if flags:
        print(k, flags)
