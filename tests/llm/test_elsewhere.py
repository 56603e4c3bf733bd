"""A text operator with Python workers, in a session that was started from another folder."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

START = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", r"{HERE}/__spark_entry__.py")
e = importlib.util.module_from_spec(spec)
spec.loader.exec_module(e)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
print("ROWS", e.queries()["op5_token_count"](spark, "/root/testdata/sf0.001").where("n_tokens >= 0").count())
"""


def test_tokens_counted_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", START], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200" in out.stdout, out.stderr[-3000:]
