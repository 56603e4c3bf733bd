"""Python workers import the package although the session was started elsewhere."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ELSEWHERE = """
import importlib.util, os
spec = importlib.util.spec_from_file_location("__spark_entry__", r"{entry}")
e = importlib.util.module_from_spec(spec)
spec.loader.exec_module(e)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
e.ship(spark)
e.ship(spark)

def where(batches):
    import lotmarket.functions.core as core
    for b in batches:
        yield b.assign(path=core.__file__)

print("PATH", spark.range(3).selectExpr("id", "'' as path").mapInPandas(where, "id long, path string").first().path)
{more}
"""


def run_elsewhere(tmp_path, more=""):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "start.py"
    script.write_text(ELSEWHERE.format(entry=os.path.join(HERE, "__spark_entry__.py"), more=more))
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout


def test_workers_import_the_package(tmp_path):
    path = run_elsewhere(tmp_path).split("PATH ")[1].split()[0]
    assert "lotmarket-code.zip" in path


def test_zip_holds_every_module():
    import io
    import zipfile

    from lotmarket.session import package_zip
    names = zipfile.ZipFile(io.BytesIO(package_zip())).namelist()
    assert "lotmarket/__init__.py" in names and "lotmarket/operators/stats.py" in names
