"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "venuelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; a cluster's own settings win over these."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # A task that writes to few folders keeps their files open instead of sorting its rows by folder.
        "spark.sql.maxConcurrentOutputFileWriters": "64",
        # Recording the call site of every column expression makes building large ones slow.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the session names, gone when the application ends.

    The setting ``spark.checkpoint.dir`` is read from the session. Only a local
    session may lack it; then a temporary folder is made and the setting filled in.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="venuelens-")
        spark.conf.set(CHECKPOINT_DIR, root)
    own = os.path.join(root, spark.sparkContext.applicationId)
    place = spark._jvm.org.apache.hadoop.fs.Path(own)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        store.mkdirs(place)
        store.deleteOnExit(place)
    return os.path.join(own, f"{name}-{uuid.uuid4().hex}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder through the file system of its path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan over all cores, for work that costs far more per row than moving the row.

    Only an input with fewer splits than cores is moved, such as one file with
    one row group; a large input has enough splits and stays as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
