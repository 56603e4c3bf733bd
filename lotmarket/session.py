"""Session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames.  ``local_session`` is for tests, the bench and scripts; on a cluster
the caller's session (and its ``spark.checkpoint.dir``) is used as-is.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session of ours carries.  ANSI stays on (the Spark 4 default);
# operators use try_* functions where the reference turns bad values into NULL.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lotmarket", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("LOTMARKET_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only a local session without one gets a scratch folder of this machine; on a
    cluster ``spark.checkpoint.dir`` must be set, to storage all machines share.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="lotmarket-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the checkpoint area for written intermediate tables.

    Written tables cut lineage and survive executor loss; they live in the same
    shared folder the cluster names for checkpoints.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def package_zip() -> bytes:
    """The package's sources as a zip that Python can import from."""
    root = os.path.dirname(os.path.abspath(__file__))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    return out.getvalue()


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers of this session, wherever it was started from.

    The zip goes to the shared checkpoint folder once per session; Spark hands it to each executor.
    """
    key = "spark.lotmarket.shipped"
    app = spark.sparkContext.applicationId
    if spark.conf.get(key, "") == app:
        return
    path = scratch_path(spark, "code") + "/lotmarket-code.zip"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    try:
        out.write(bytearray(package_zip()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(path)
    spark.conf.set(key, app)
