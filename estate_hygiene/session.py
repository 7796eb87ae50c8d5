"""Session settings the library relies on, and where it may cut lineage."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Wall-clock output and time text are only right in a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, removed when the application ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/estate-hygiene/{name}-{uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: there, driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="estate-hygiene-")
    return _local_folders[application]
