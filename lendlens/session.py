"""Spark session and shared-storage helpers.

Library code never creates a session itself; it receives one. ``get_spark``
is a convenience for tests, the benchmark and command-line runs.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "lendlens") -> SparkSession:
    """Build (or reuse) a session tuned for local runs.

    On a cluster the submitter's configuration wins: ``getOrCreate`` returns
    the existing session and the settings below only fill gaps.
    """
    master = master or os.environ.get("LENDLENS_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LENDLENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets this to shared storage and we only read it.
    When it is unset (local tests) we set a fresh scratch folder, removed when
    the process ends; without a local master that would be a folder the
    executors don't see, so it is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local") \
                or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lendlens-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package: a zip of its modules, added once per application.

    Python functions in tasks are sent by module name, so a worker needs the
    package on its path even when the driver found it in its own folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lendlens-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "lendlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for where, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared scratch folder.

    A table there survives executor loss (unlike a local checkpoint), keeps
    long fit/transform lineages from growing, and lets every later pass read
    only the columns it uses. Column metadata stay with the schema.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
