"""Intermediate tables: written to the shared folder of the cluster and read back, which also cuts lineage. Memory of
Python workers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    """The shared folder that the session names; a local master without one gets a folder of its own."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    named = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set(CHECKPOINT_DIR, named)
    return named


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once and read back. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Hands what this process has freed back to the system. A Python worker lives on from task to task and would hold
    the most that any of them took, beside the memory of the tasks that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
