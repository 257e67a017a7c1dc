"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "ledger_sync", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path in a new folder of its own, which goes when the driver ends.

    The folder lies in the shared folder the cluster names in ``spark.checkpoint.dir``; where none
    is named, below Spark's warehouse folder, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    own = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{own}/data"
