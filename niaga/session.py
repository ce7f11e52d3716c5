"""Session helpers: a local session for tests and the shared folder for written tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_local_root: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "niaga", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. A cluster brings its own."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder for written tables: ``spark.checkpoint.dir``, as the cluster names it.

    Only a local session without that setting gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="niaga-")
    return _local_root[app]
